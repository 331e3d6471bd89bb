"""Registered queries: one per operator of the inventory, over the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame``. The retail deliveries are
derived from the driver's tables by :mod:`terrace.sources.fixtures`; every
query runs over whole tables. Exact-checked outputs expose natural keys (not the
``xxhash64`` surrogate keys, which the SQL oracle cannot compute) and money as
DOUBLE after exact decimal rounding.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from terrace.functions.identity import surrogate_key
from terrace.functions.normalize import UNREADABLE, email_ok, typed
from terrace.operators import quality as Q
from terrace.operators import rules as R
from terrace.operators.dedupe import latest_per_key, set_difference
from terrace.operators.merge import insert_only_merged, upsert
from terrace.operators.scd2 import apply_scd2, detect_changes, expire, first_load
from terrace.plans import bronze as B
from terrace.plans import gold as G
from terrace.plans import lakehouse as L
from terrace.plans import questions
from terrace.plans import silver as S
from terrace.session import fresh_path, shuffles_freed
from terrace.sources import fixtures as X
from terrace.sources import landing
from terrace.sources.contracts import ORDER_CONTRACT, PRODUCT_CONTRACT

AS_OF_DATE = X.DAY1.date()
# Rows in a compressed file of a delivery: a task reads some dozens of these at once.
ROWS_PER_FILE = 50_000


def money_as_double(df: DataFrame) -> DataFrame:
    """Decimal columns → DOUBLE for the cross-engine comparison (after exact rounding)."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _memo(method):
    """Build each sub-result once per World: one plan object per table, so the
    Python-side plan construction is not repeated and Spark can reuse exchanges."""

    def wrapper(self, *args):
        key = (method.__name__, *[id(a) if isinstance(a, DataFrame) else a for a in args])
        if key not in self._memo:
            self._memo[key] = method(self, *args)
        return self._memo[key]

    wrapper.__name__ = method.__name__
    return wrapper


class World:
    """The whole pipeline over the fixture deliveries, built lazily per query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir
        self._memo: dict = {}
        self._staged_orders = False

    # bronze
    @_memo
    def bronze_customers(self, day=1):
        return X.bronze_customers(self.spark, self.sf, day)

    @_memo
    def bronze_products(self, day=1):
        return X.bronze_products(self.spark, self.sf, day)

    @_memo
    def bronze_orders(self):
        return X.bronze_orders(self.spark, self.sf)

    # silver
    @_memo
    def customers_classified(self, day=1):
        return S.customers_classified(self.bronze_customers(day))

    @_memo
    def customers_incoming(self, day=1):
        return S.customers_incoming(self.customers_classified(day))

    @_memo
    def customers_history(self):
        return S.customers_history(None, self.customers_incoming(1), X.DAY1)

    @_memo
    def products_classified(self, bronze=None):
        return S.products_classified(bronze if bronze is not None else self.bronze_products(1))

    @_memo
    def products(self):
        return S.products_valid(self.products_classified())

    @_memo
    def orders_checked(self, bronze=None):
        b = bronze if bronze is not None else self.bronze_orders()
        return S.orders_checked(b, self.customers_history(), self.products())

    @_memo
    def orders_classified(self, bronze=None):
        return S.orders_classified(self.orders_checked(bronze))

    def staged_sales(self, bronze):
        """The sales of Bronze rows, written; so are the latest orders before their check."""
        checked = S.orders_checked(bronze, self.customers_history(), self.products(), written=_staged, carried=["_batch_id", "_ingested_at"])
        return _staged(S.sales_of_checked(checked), "sales")

    def staged_invalid(self, bronze):
        """The classified orders of Bronze rows that go to the quarantine, written; so are the latest orders before their check."""
        checked = S.orders_checked(bronze, self.customers_history(), self.products(), written=_staged, carried=["_batch_id", "_source_file"])
        return _staged(R.invalid_rows(S.orders_classified(checked)).select(*S.ORDER_PAYLOAD, R.REASON), "orders-invalid")

    @_memo
    def sales(self, bronze=None):
        if self._staged_orders:
            return S.sales_rows(self.orders_classified(bronze))
        return S.sales_of_checked(self.orders_checked(bronze))

    # gold
    @_memo
    def dim_customer(self):
        return G.dim_customer(self.customers_history())

    @_memo
    def dim_product(self):
        return G.dim_product(self.products())

    @_memo
    def sales_looked_up(self):
        """Sales whose reference check is the join with the dimensions: the fact needs no second one on the same keys."""
        if self._staged_orders:
            return R.valid_rows(self.orders_classified()).select(*S.SALES_COLUMNS, *[c for columns in G.LOOKED_UP.values() for c in columns])
        current = self.dim_customer().withColumn("is_current", F.lit(True))
        checked = S.orders_checked(self.bronze_orders(), current, self.dim_product(), G.LOOKED_UP)
        return S.sales_of_checked(checked, [c for columns in G.LOOKED_UP.values() for c in columns])

    @_memo
    def fact(self, *natural_keys):
        return G.fact_sales(self.sales_looked_up(), self.dim_customer(), self.dim_product(), natural_keys)

    @_memo
    def daily(self):
        return G.daily_sales(self.fact())

    @_memo
    def c360(self):
        return G.customer_360(self.fact(), self.dim_customer(), AS_OF_DATE)

    @_memo
    def perf(self):
        return G.product_performance(self.fact(), self.dim_product())

    def stage_orders(self):
        """Write the classified orders once, for a query that reads them again and again, with what the fact takes from the
        dimensions: every mart then makes the fact from these rows as they are read. The products are looked up in
        their reference check; a customer's key is a hash of the id that was checked. Only rows that go to the quarantine
        keep the copy of their source, which nothing else shows."""
        by_product = {"_product_exists": G.LOOKED_UP["_product_exists"]}
        lineage = ["_batch_id", "_ingested_at", "_source_file"]
        found = S.orders_classified(S.orders_checked(self.bronze_orders(), self.customers_history(), self.dim_product(), by_product, _staged, lineage))
        found = found.withColumn("customer_key", surrogate_key("customer_id"))
        taken = [c for columns in G.LOOKED_UP.values() for c in columns]
        shown = [c for c in found.columns if c in {*S.ORDER_PAYLOAD, *S.SALES_COLUMNS, *taken, R.REASON} and c != S.RAW]
        held = _staged(found.select(*shown, F.when(F.col(R.REASON).isNotNull(), F.col(S.RAW)).alias(S.RAW)), "orders-classified")
        self._memo["orders_classified",] = self._memo["orders_classified", None] = held
        self._staged_orders = True

    @_memo
    def quarantine_all(self):
        return (
            S.customers_quarantine(self.customers_classified(), AS_OF_DATE)
            .unionByName(S.products_quarantine(self.products_classified(), AS_OF_DATE))
            .unionByName(S.orders_quarantine(self.orders_classified(), AS_OF_DATE))
        )


# ----------------------------------------------------------------------------- scans
def _staged_scan(spark: SparkSession, entity: str, delivery: DataFrame) -> DataFrame:
    root = fresh_path(spark, "landing")
    landing.write_delivery(delivery, root, entity)
    return landing.scan(spark, root, entity, with_source_file=False)


def q_scan_csv_customers(spark, sf):
    src = X.customers_source(spark, sf).withColumn("batch_date", F.lit(X.DAY1.date()))
    return _staged_scan(spark, "customers", src)


def q_scan_json_products(spark, sf):
    """A delivery of JSON numbers and some broken lines: every value as its text, every broken line whole."""
    lines = X.product_lines(X.products_source(spark, sf).withColumn("batch_date", F.lit(X.DAY1.date())))
    root = fresh_path(spark, "landing")
    lines.write.partitionBy("batch_date").text(landing.entity_path(root, "products"))
    return landing.scan(spark, root, "products", with_source_file=False)


def q_scan_csv_orders(spark, sf):
    src = X.orders_source(spark, sf).withColumns(
        {
            "ordered_at": F.col("ordered_at").cast("string"),
            "batch_date": F.trunc(F.to_date("_delivered_at"), "month"),
        }
    )
    return _staged_scan(spark, "orders", src)


# ----------------------------------------------------------------------------- identity
def q_ingest_lineage(spark, sf):
    return World(spark, sf).bronze_customers(1).drop("_record_hash", "_bronze_record_id")


def q_record_hash(spark, sf):
    return World(spark, sf).bronze_orders().select("order_id", "_source_file", "_record_hash", "_bronze_record_id")


def q_attribute_hash(spark, sf):
    return World(spark, sf).customers_incoming(1).select("customer_id", "attribute_hash")


def q_surrogate_keys(spark, sf):
    """Per kind: rows, distinct natural and surrogate keys, negative keys."""
    w = World(spark, sf)
    parts = [(w.dim_customer(), "customer", "customer_id", "customer_key"), (w.dim_product(), "product", "product_id", "product_key"),
             (w.fact(), "sale", "order_id", "sales_key")]
    return reduce(DataFrame.unionByName, [
        df.groupBy(F.lit(kind).alias("kind")).agg(
            F.count(F.lit(1)).alias("key_rows"), F.countDistinct(natural).alias("natural_keys"), F.countDistinct(key).alias("surrogate_keys"),
            F.count_if(F.col(key) < 0).alias("negative_keys"))
        for df, kind, natural, key in parts
    ])


def q_surrogate_key_rows(spark, sf):
    """Every natural key of the dimensions and the fact with its surrogate key."""
    w = World(spark, sf)
    parts = [(w.dim_customer(), "customer", "customer_id", "customer_key"), (w.dim_product(), "product", "product_id", "product_key"),
             (w.fact(), "sale", "order_id", "sales_key")]
    return reduce(DataFrame.unionByName, [df.select(F.lit(kind).alias("kind"), F.col(n).alias("natural_key"), F.col(k).alias("surrogate_key")) for df, kind, n, k in parts])


def q_bronze_from_landing(spark, sf):
    """Two deliveries of every feed written as files, ingested, and ingested again: what Bronze holds per delivery."""
    root, lake = fresh_path(spark, "landing"), L.Lakehouse(fresh_path(spark, "lake"))
    day = lambda d: F.lit(d.date()).alias("batch_date")
    sent = {"compression": "gzip", "rows_per_file": ROWS_PER_FILE}
    for d, customers, products in ((X.DAY1, X.customers_source, X.products_source), (X.DAY2, X.customers_source_day2, X.products_source_day2)):
        landing.write_delivery(customers(spark, sf).select("*", day(d)), root, "customers", **sent)
        landing.write_delivery(products(spark, sf).select("*", day(d)), root, "products", **sent)
    orders = X.orders_source(spark, sf).withColumns({"ordered_at": F.col("ordered_at").cast("string"), "batch_date": F.trunc(F.to_date("_delivered_at"), "month")})
    landing.write_delivery(orders, root, "orders", **sent)
    L.ingest_landing(spark, lake, root)
    L.ingest_landing(spark, lake, root)  # inserts nothing
    tables = [spark.read.parquet(lake.path("bronze", e)).withColumn("entity", F.lit(e)) for e in B.ENTITIES]
    held = reduce(DataFrame.unionByName, [t.select("entity", "batch_date", "_batch_id", "_record_hash", "_source_system") for t in tables])
    return held.groupBy("entity", "batch_date", "_source_system").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(F.unhex("_record_hash")).alias("records"), F.count_distinct("_batch_id").alias("batches"))


# ----------------------------------------------------------------------------- merges
def q_ingest_summary(spark, sf):
    w = World(spark, sf)
    parts = []
    c1 = w.bronze_customers(1)
    parts.append(B.ingest_counts("customers", c1.unionByName(w.bronze_customers(2)),
                                 B.new_records(c1, c1.unionByName(w.bronze_customers(2)))))
    p1 = w.bronze_products(1)
    parts.append(B.ingest_counts("products", p1.unionByName(w.bronze_products(2)),
                                 B.new_records(p1, p1.unionByName(w.bronze_products(2)))))
    o_all = w.bronze_orders()
    o1, _ = X.split_at_cutoff(o_all)
    parts.append(B.ingest_counts("orders", o_all, B.new_records(o1, o_all)))
    return reduce(DataFrame.unionByName, parts)


def q_merge_insert_only(spark, sf):
    o_all = World(spark, sf).bronze_orders()
    o1, _ = X.split_at_cutoff(o_all)
    merged = insert_only_merged(o1, o_all)
    return merged.select("order_id", "_batch_id", "_ingested_at", "_bronze_record_id")


def q_latest_per_key(spark, sf):
    latest = latest_per_key(World(spark, sf).bronze_orders(), "order_id")
    return latest.select("order_id", "customer_id", "product_id", "quantity", "unit_price", "_ingested_at", "_record_hash")


def q_merge_upsert_products(spark, sf):
    w = World(spark, sf)
    day1 = w.products()
    all_bronze = w.bronze_products(1).unionByName(w.bronze_products(2))
    incoming = S.products_valid(S.products_classified(all_bronze))
    return money_as_double(upsert(day1, incoming, "product_id"))


def q_merge_upsert_sales(spark, sf):
    w = World(spark, sf)
    o_all = w.bronze_orders()
    o1, _ = X.split_at_cutoff(o_all)
    sales1 = w.staged_sales(o1)
    sales2 = w.staged_sales(o_all)
    return money_as_double(upsert(sales1, sales2, "order_id"))


def q_set_difference(spark, sf):
    normalized = S.customers_normalized(World(spark, sf).bronze_customers(1)).select(*NORMALIZED)
    invalid = R.invalid_rows(R.classify(normalized, S.customer_rules())).select(*NORMALIZED)
    return set_difference(normalized, invalid)


# ----------------------------------------------------------------------------- scd2
def q_scd2_first_load(spark, sf):
    hist = first_load(World(spark, sf).customers_incoming(1), X.DAY1)
    return hist.select("customer_id", "segment", "attribute_hash", "valid_from", "valid_to", "is_current")


def q_scd2_changes(spark, sf):
    w = World(spark, sf)
    current = w.customers_history().filter(F.col("is_current"))
    return detect_changes(w.customers_incoming(2), current, "customer_id").select(
        "customer_id", "segment", "email", "attribute_hash"
    )


def q_scd2_expire(spark, sf):
    w = World(spark, sf)
    hist = w.customers_history()
    changed = detect_changes(w.customers_incoming(2), hist.filter(F.col("is_current")), "customer_id")
    return expire(hist, changed, "customer_id", X.DAY2).select(
        "customer_id", "segment", "valid_from", "valid_to", "is_current"
    )


def q_scd2_apply(spark, sf):
    w = World(spark, sf)
    hist = apply_scd2(w.customers_history(), w.customers_incoming(2), "customer_id", X.DAY2)
    return hist.select(
        "customer_id", "segment", "email", "signup_date", "attribute_hash", "valid_from", "valid_to", "is_current"
    )


# ----------------------------------------------------------------------------- validation
NORMALIZED = ["customer_id", "full_name", "email", "city", "country", "segment", "signup_date", "source_updated_at"]


def q_customers_normalized(spark, sf):
    return S.customers_normalized(World(spark, sf).bronze_customers(1)).select(*NORMALIZED)


def q_customers_invalid(spark, sf):
    return R.invalid_rows(World(spark, sf).customers_classified(1)).select("customer_id", "email", R.REASON)


def q_customers_valid(spark, sf):
    return World(spark, sf).customers_incoming(1).select(*NORMALIZED)


def q_customers_quarantine(spark, sf):
    return S.customers_quarantine(World(spark, sf).customers_classified(1), AS_OF_DATE)


def q_products_valid(spark, sf):
    return money_as_double(World(spark, sf).products())


def q_products_quarantine(spark, sf):
    return S.products_quarantine(World(spark, sf).products_classified(), AS_OF_DATE)


def q_orders_ref_check(spark, sf):
    return World(spark, sf).orders_checked().select(
        "order_id", "customer_id", "product_id", "_customer_exists", "_product_exists"
    )


def q_orders_valid(spark, sf):
    return money_as_double(World(spark, sf).sales())


def q_orders_quarantine(spark, sf):
    return S.orders_quarantine(World(spark, sf).orders_classified(), AS_OF_DATE)


def q_quarantine_idempotent(spark, sf):
    """The quarantine after a run over the first order deliveries and, a day later, one over all of them."""
    w = World(spark, sf)
    all_orders = w.bronze_orders()
    first, _ = X.split_at_cutoff(all_orders)
    stored = S.orders_quarantine(w.staged_invalid(first), AS_OF_DATE)
    again = S.orders_quarantine(w.staged_invalid(all_orders), X.DAY2.date())
    return insert_only_merged(stored, again, "_quarantine_id")


def q_quarantine_counts(spark, sf):
    return R.quarantine_counts(World(spark, sf).quarantine_all())


def q_order_financials(spark, sf):
    latest = latest_per_key(World(spark, sf).bronze_orders(), "order_id")
    return money_as_double(
        S.order_financials(latest).select(
            "order_id", "ordered_at", "order_date", "gross_amount", "net_amount", "discount_amount"
        )
    )


# ----------------------------------------------------------------------------- gold
def q_dim_customer(spark, sf):
    return World(spark, sf).dim_customer().drop("customer_key")


def q_dim_product(spark, sf):
    return money_as_double(World(spark, sf).dim_product().drop("product_key"))


def q_fact_sales(spark, sf):
    named = World(spark, sf).fact("customer_id", "product_id")
    return money_as_double(named.drop("sales_key", "customer_key", "product_key"))


def q_daily_sales(spark, sf):
    return money_as_double(World(spark, sf).daily())


def q_customer_360(spark, sf):
    return money_as_double(World(spark, sf).c360().drop("customer_key"))


def q_product_performance(spark, sf):
    return money_as_double(World(spark, sf).perf().drop("product_key"))


# ----------------------------------------------------------------------------- quality
def silver_suite(w: World) -> DataFrame:
    sales = w.sales()
    current = w.customers_history().filter(F.col("is_current"))
    return Q.suite(
        [
            (sales, [Q.not_null("order_id"), Q.unique("order_id"), Q.positive("quantity"),
                     Q.non_negative("unit_price")]),
            (current, [Q.not_null("customer_id"), Q.unique("customer_id")]),
            (w.products(), [Q.unique("product_id")]),
        ]
    )


def gold_suite(w: World) -> DataFrame:
    fact = w.fact()
    return Q.suite(
        [
            (fact, [Q.not_null("sales_key"), Q.unique("order_id"), Q.non_negative("net_amount")]),
            (w.dim_customer(), [Q.unique("customer_key")]),
            (w.dim_product(), [Q.unique("product_key")]),
        ]
    )


def q_quality_silver(spark, sf):
    return silver_suite(World(spark, sf)).drop("_order")


def q_quality_gold(spark, sf):
    return gold_suite(World(spark, sf)).drop("_order")


def q_quality_raw(spark, sf):
    """The checks over un-cleaned Bronze, typed but not validated: every kind of check finds failing rows."""
    w = World(spark, sf)
    customers = S.customers_normalized(w.bronze_customers(1).unionByName(w.bronze_customers(2)))
    products, orders = typed(w.bronze_products(1), PRODUCT_CONTRACT), typed(w.bronze_orders(), ORDER_CONTRACT)
    return Q.suite(
        [
            (orders, [Q.unique("order_id"), Q.not_null("quantity"), Q.positive("quantity"), Q.non_negative("unit_price"),
                      Q.row_rule("orders_readable", F.col(UNREADABLE).isNotNull())]),
            (customers, [Q.unique("customer_id"), Q.not_null("email"), Q.row_rule("email_plausible", ~email_ok("email"))]),
            (products, [Q.not_null("product_id"), Q.unique("product_id"), Q.non_negative("unit_cost"), Q.not_null("unit_cost")]),
        ]
    ).drop("_order")


def q_quarantine_rate(spark, sf):
    return Q.quarantine_rate(World(spark, sf).orders_classified())


def q_stage_summary(spark, sf):
    w = World(spark, sf)
    w.stage_orders()
    q = w.quarantine_all()
    tables = {
        "silver_customer_versions": w.customers_history(),
        "silver_products": w.products(),
        "silver_sales": w.sales(),
        "quarantined_customers": q.filter(F.col("_entity") == "customer"),
        "quarantined_orders": q.filter(F.col("_entity") == "order"),
        "dim_customers": w.dim_customer(),
        "dim_products": w.dim_product(),
        "fact_sales": w.fact(),
        "daily_sales_rows": w.daily(),
        "customer_360_rows": w.c360(),
        "product_performance_rows": w.perf(),
    }
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


# ----------------------------------------------------------------------------- questions
def _ask(question: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf):
        w = World(spark, sf)
        frames = {"daily_sales": w.daily, "customer_360": w.c360, "product_performance": w.perf}
        return money_as_double(questions.ask(question, lambda table: frames[table]()))

    run.__name__ = f"q_bq_{question}"
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_csv_customers": q_scan_csv_customers,
    "scan_json_products": q_scan_json_products,
    "scan_csv_orders": q_scan_csv_orders,
    "ingest_lineage": q_ingest_lineage,
    "record_hash": q_record_hash,
    "attribute_hash": q_attribute_hash,
    "surrogate_keys": q_surrogate_keys,
    "surrogate_key_rows": q_surrogate_key_rows,
    "bronze_from_landing": q_bronze_from_landing,
    "ingest_summary": q_ingest_summary,
    "merge_insert_only": q_merge_insert_only,
    "latest_per_key": q_latest_per_key,
    "merge_upsert_products": q_merge_upsert_products,
    "merge_upsert_sales": q_merge_upsert_sales,
    "set_difference": q_set_difference,
    "scd2_first_load": q_scd2_first_load,
    "scd2_changes": q_scd2_changes,
    "scd2_expire": q_scd2_expire,
    "scd2_apply": q_scd2_apply,
    "customers_normalized": q_customers_normalized,
    "customers_invalid": q_customers_invalid,
    "customers_valid": q_customers_valid,
    "customers_quarantine": q_customers_quarantine,
    "products_valid": q_products_valid,
    "products_quarantine": q_products_quarantine,
    "orders_ref_check": q_orders_ref_check,
    "orders_valid": q_orders_valid,
    "orders_quarantine": q_orders_quarantine,
    "quarantine_counts": q_quarantine_counts,
    "quarantine_idempotent": q_quarantine_idempotent,
    "order_financials": q_order_financials,
    "dim_customer": q_dim_customer,
    "dim_product": q_dim_product,
    "fact_sales": q_fact_sales,
    "daily_sales": q_daily_sales,
    "customer_360": q_customer_360,
    "product_performance": q_product_performance,
    "quality_silver": q_quality_silver,
    "quality_gold": q_quality_gold,
    "quality_raw": q_quality_raw,
    "quarantine_rate": q_quarantine_rate,
    "stage_summary": q_stage_summary,
    "bq_daily_trend": _ask("daily_trend"),
    "bq_top_customers": _ask("top_customers"),
    "bq_best_products": _ask("best_products"),
    "bq_channel_mix": _ask("channel_mix"),
}
