"""Retail-shaped deliveries derived from the driver's Parquet tables.

The driver ships TPC-H-like tables without defects. These builders reshape
``customer``, ``part``, ``orders`` and ``lineitem`` into the three landing feeds
(customers, products, orders) and plant the defect patterns the pipeline must
handle. Every row of the input tables is carried; defects are injected by a
deterministic rule on the key, nothing is filtered out.

The same views are written as SQL in :mod:`terrace.oracle` for the DuckDB check.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, StringType

from terrace.functions.normalize import ntz_literal
from terrace.operators.lineage import with_lineage
from terrace.sources.contracts import SOURCE_SYSTEMS
from terrace.sources.tables import load

# Fixed run instants of the two deliveries and the orders re-delivery cut-off.
DAY1 = _dt.datetime(1999, 1, 1, 0, 0, 0)
DAY2 = _dt.datetime(1999, 1, 2, 0, 0, 0)
ORDERS_CUTOFF = _dt.datetime(1996, 1, 1, 0, 0, 0)
# Fixed defect moduli (rows whose key is a multiple get the defect).
BLANK_CUSTOMER_ID = 97
BAD_EMAIL = 89
NULL_EMAIL = 83
BAD_SIGNUP_DATE = 79
NULL_PRODUCT_ID = 137
NEGATIVE_COST = 131
UNKNOWN_CUSTOMER = 113
ZERO_QUANTITY = 103
NULL_QUANTITY = 107
NEGATIVE_PRICE = 109
# Fixed types of the numbers that the source systems send as text, and what they plant beside.
PRICE, RATE = DecimalType(12, 2), DecimalType(5, 4)
BROKEN_LINE = 139
TENTH_CENTS = 101
WORD_QUANTITY = 127
FINE_PRICE = 149
FINE_COST = 151
# Day-2 change rules (customers: segment rotation; products: price step).
SEGMENT_CHANGE = 10
PRICE_CHANGE = 7


def _pad(col: Column) -> Column:
    """Zero-pad a key to at least six digits (longer keys are kept whole, never cut).

    ``lpad`` alone truncates longer strings; ``format_string`` is a per-row
    ``java.util.Formatter`` call, ~3x slower than this codegen'd form.
    """
    text = col.cast(StringType())
    return F.when(F.length(text) >= 6, text).otherwise(F.lpad(text, 6, "0"))


def _landing_file(entity: str, day: Column | str) -> Column:
    d = day if isinstance(day, Column) else F.lit(day)
    return F.concat(F.lit(f"landing/{entity}/batch_date="), d, F.lit(f"/{entity}.part-0"))


def customers_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """crm: one row per customer, id and email un-normalised, planted defects."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    joined = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    signup = F.date_add(F.lit("1995-01-01").cast("date"), (k % 1460).cast(IntegerType()))
    updated = F.date_add(F.lit("1998-01-01").cast("date"), (k % 365).cast(IntegerType()))
    return joined.select(
        k.alias("_custkey"),
        F.when(k % BLANK_CUSTOMER_ID == 0, F.lit(" "))
        .otherwise(F.concat(F.lit(" c"), _pad(k)))
        .alias("customer_id"),
        F.concat(F.col("c_name"), F.lit(" ")).alias("full_name"),
        F.when(k % BAD_EMAIL == 0, F.lit("not-an-email"))
        .when(k % NULL_EMAIL == 0, F.lit(None).cast(StringType()))
        .otherwise(F.concat(F.lit("User."), k.cast(StringType()), F.lit("@Example.test")))
        .alias("email"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.col("c_mktsegment").alias("segment"),
        F.when(k % BAD_SIGNUP_DATE == 0, F.lit("not-a-date"))
        .otherwise(signup.cast(StringType()))
        .alias("signup_date"),
        F.concat(updated.cast(StringType()), F.lit(" 00:00:00")).alias("updated_at"),
    )


def customers_source_day2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second customer delivery: every customer again.

    * key % 10 == 0: segment rotated (a real change → new SCD2 version);
    * key % 10 == 1: only ``signup_date`` moves (not an SCD2 attribute → no version);
    * bad e-mails of day 1 corrected (quarantined keys arrive as new customers).
    """
    day1 = customers_source(spark, sf_dir)
    k = F.col("_custkey")
    return day1.select(
        "_custkey",
        "customer_id",
        "full_name",
        F.when(k % BAD_EMAIL == 0, F.concat(F.lit("fixed."), k.cast(StringType()), F.lit("@example.test")))
        .otherwise(F.col("email"))
        .alias("email"),
        "city",
        "country",
        F.when(k % SEGMENT_CHANGE == 0, F.concat(F.col("segment"), F.lit("-PLUS")))
        .otherwise(F.col("segment"))
        .alias("segment"),
        F.when((k % SEGMENT_CHANGE == 1) & (k % BAD_SIGNUP_DATE != 0), F.lit("1994-12-31"))
        .otherwise(F.col("signup_date"))
        .alias("signup_date"),
        F.concat(F.lit(DAY2.date().isoformat()), F.lit(" 00:00:00")).alias("updated_at"),
    )


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(StringType()) for c in columns})


def products_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pr: one row per part, values as text; NULL ids, negative costs and costs in millionths planted."""
    fine = F.when(F.col("_partkey") % FINE_COST == 0, F.lit("0001")).otherwise(F.lit(""))
    text = _as_text(_products(spark, sf_dir), "unit_cost", "list_price", "active")
    return text.withColumn("unit_cost", F.concat("unit_cost", fine))


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    k = F.col("p_partkey")
    price = F.col("p_retailprice").cast(PRICE)
    sign = F.when(k % NEGATIVE_COST == 0, F.lit(-1)).otherwise(F.lit(1))
    return p.select(
        k.alias("_partkey"),
        F.when(k % NULL_PRODUCT_ID == 0, F.lit(None).cast(StringType()))
        .otherwise(F.concat(F.lit("P"), _pad(k)))
        .alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.round(price * F.lit(0.6).cast("decimal(3,1)") * sign, 2).cast(PRICE).alias("unit_cost"),
        price.alias("list_price"),
        F.lit(True).alias("active"),
        F.concat(F.lit(DAY1.date().isoformat()), F.lit(" 00:00:00")).alias("updated_at"),
    )


def products_source_day2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second product delivery: list price +1 for key % 7 == 0, negative and too fine costs corrected."""
    day1 = _products(spark, sf_dir)
    k = F.col("_partkey")
    changed = day1.select(
        "_partkey",
        "product_id",
        "product_name",
        "category",
        F.abs(F.col("unit_cost")).cast(PRICE).alias("unit_cost"),
        F.when(k % PRICE_CHANGE == 0, (F.col("list_price") + F.lit(1)).cast(PRICE))
        .otherwise(F.col("list_price"))
        .alias("list_price"),
        "active",
        F.concat(F.lit(DAY2.date().isoformat()), F.lit(" 00:00:00")).alias("updated_at"),
    )
    return _as_text(changed, "unit_cost", "list_price", "active")


def product_lines(products: DataFrame) -> DataFrame:
    """``(batch_date, value)``: products as the lines of an NDJSON delivery with numbers as numbers; some lines are cut off."""
    price, flag = (lambda c: F.col(c).cast("decimal(18,6)").alias(c)), F.col("active").cast("boolean").alias("active")
    line = F.to_json(F.struct("product_id", "product_name", "category", price("unit_cost"), price("list_price"), flag, "updated_at"))
    cut = F.when(F.col("_partkey") % BROKEN_LINE == 0, F.expr("left(line, length(line) - 7)")).otherwise(F.col("line"))
    return products.withColumn("line", line).select("batch_date", cut.alias("value"))


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ord: one row per line item, ``order_id`` repeats (re-deliveries).

    Each row keeps its delivery instant (``l_shipdate``) as ``_delivered_at``. Numbers are text.
    Defects: unknown customer, zero, NULL and worded quantity, negative price, prices in
    tenths of a cent (which are right) and in millionths (which are not).
    """
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_shipdate"
    )
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    k = F.col("l_orderkey")
    # The price comes first, while rows are narrow. Then line items are hash-partitioned
    # on the order key: the exchange a sort-merge join with ``orders`` needs at scale
    # anyway, it spreads the per-row work (parsing, hashing) over all tasks even when
    # ``orders`` is small enough to broadcast and the source file is a single row group,
    # and deliveries of one line lie together, so the latest is found before they are sent on.
    priced = li.join(p, li.l_partkey == p.p_partkey).repartition(F.col("l_orderkey"))
    joined = priced.join(o, priced.l_orderkey == o.o_orderkey)
    sign = F.when(k % NEGATIVE_PRICE == 0, F.lit(-1)).otherwise(F.lit(1))
    return joined.select(
        F.concat(F.lit("O"), k.cast(StringType()), F.lit("-"), F.col("l_linenumber").cast(StringType())).alias(
            "order_id"
        ),
        F.when(k % UNKNOWN_CUSTOMER == 0, F.lit("C999999"))
        .otherwise(F.concat(F.lit("C"), _pad(F.col("o_custkey"))))
        .alias("customer_id"),
        F.concat(F.lit("P"), _pad(F.col("l_partkey"))).alias("product_id"),
        F.col("o_orderdate").alias("ordered_at"),
        F.when(k % ZERO_QUANTITY == 0, F.lit("0"))
        .when(k % NULL_QUANTITY == 0, F.lit(None).cast(StringType()))
        .when(k % WORD_QUANTITY == 0, F.lit("two"))
        .otherwise(F.col("l_quantity").cast(IntegerType()).cast(StringType()))
        .alias("quantity"),
        F.concat(
            (F.col("p_retailprice") * sign).cast(PRICE).cast(StringType()),
            F.when(k % TENTH_CENTS == 0, F.lit("1")).when(k % FINE_PRICE == 0, F.lit("0001")).otherwise(F.lit("")),
        ).alias("unit_price"),
        F.col("l_discount").cast(RATE).cast(StringType()).alias("discount_pct"),
        F.col("o_orderpriority").alias("channel"),
        F.col("l_returnflag").alias("status"),
        F.lit("USD").alias("currency"),
        F.col("l_shipdate").alias("_delivered_at"),
    )


ORDER_SOURCE_COLUMNS = [
    "order_id", "customer_id", "product_id", "ordered_at", "quantity",
    "unit_price", "discount_pct", "channel", "status", "currency",
]
CUSTOMER_SOURCE_COLUMNS = [
    "customer_id", "full_name", "email", "city", "country", "segment", "signup_date", "updated_at",
]
PRODUCT_SOURCE_COLUMNS = [
    "product_id", "product_name", "category", "unit_cost", "list_price", "active", "updated_at",
]


def bronze_customers(spark: SparkSession, sf_dir: str, day: int = 1) -> DataFrame:
    src = customers_source(spark, sf_dir) if day == 1 else customers_source_day2(spark, sf_dir)
    at = DAY1 if day == 1 else DAY2
    return with_lineage(
        src.select(*CUSTOMER_SOURCE_COLUMNS),
        SOURCE_SYSTEMS["customers"],
        at.strftime("%Y%m%d"),
        ingested_at=at,
        source_file=_landing_file("customers", at.date().isoformat()),
    )


def bronze_products(spark: SparkSession, sf_dir: str, day: int = 1) -> DataFrame:
    src = products_source(spark, sf_dir) if day == 1 else products_source_day2(spark, sf_dir)
    at = DAY1 if day == 1 else DAY2
    return with_lineage(
        src.select(*PRODUCT_SOURCE_COLUMNS),
        SOURCE_SYSTEMS["products"],
        at.strftime("%Y%m%d"),
        ingested_at=at,
        source_file=_landing_file("products", at.date().isoformat()),
    )


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order deliveries, one per ship day, stamped as Bronze rows."""
    src = orders_source(spark, sf_dir)
    day = F.date_format(F.col("_delivered_at"), "yyyy-MM-dd")
    return with_lineage(
        src,
        SOURCE_SYSTEMS["orders"],
        F.date_format(F.col("_delivered_at"), "yyyyMMdd"),
        ingested_at=F.col("_delivered_at"),
        source_file=_landing_file("orders", day),
        source_columns=ORDER_SOURCE_COLUMNS,
    ).drop("_delivered_at")


def split_at_cutoff(bronze: DataFrame, cutoff: _dt.datetime = ORDERS_CUTOFF) -> tuple[DataFrame, DataFrame]:
    """Bronze rows ingested before / from the cut-off: run 1 and the run-2 increment."""
    before = bronze.filter(F.col("_ingested_at") < ntz_literal(cutoff))
    after = bronze.filter(F.col("_ingested_at") >= ntz_literal(cutoff))
    return before, after
