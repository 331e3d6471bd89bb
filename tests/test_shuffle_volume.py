"""What goes through a shuffle: the bytes of a record hash, and one copy of the fact."""

import datetime as dt
import hashlib
import re

from lake_testing import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.operators.dedupe import latest_per_key


def test_latest_per_key_orders_hashes_as_their_text_and_shuffles_their_bytes(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [(f"K{i % 7}", i, at, hashlib.sha256(str(i).encode()).hexdigest()) for i in range(200)]
    rows += [("T", 1, at, "b"), ("T", 2, at, "é"), ("T", 3, at, "a"), ("T", 4, at, None), ("N", 5, at, None), ("U", 6, at, "AB"), ("U", 7, at, "A" * 64)]
    df = spark.createDataFrame(rows, "k string, v int, _ingested_at timestamp_ntz, _record_hash string").repartition(5)
    order = Window.partitionBy("k").orderBy(F.col("_ingested_at").desc_nulls_last(), F.col("_record_hash").desc_nulls_last())
    want = df.withColumn("n", F.row_number().over(order)).filter("n = 1").select("k", "v")
    got = latest_per_key(df, "k").select("k", "v")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow ", line)]
    assert windows and not any("_record_hash" in line for line in windows)


def test_the_fact_below_a_rank_is_computed_once_without_broadcasts_too(spark):
    from terrace.registry import QUERIES

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = QUERIES["bq_best_products"](spark, SF_SMALL)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]  # noqa: SLF001
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"HashAggregate\(keys=\[product_key#\d+L?\], functions=\[partial_", final)) == 1


def _checked(spark):
    """Checked orders of every kind: valid, and breaking one rule each or several."""
    from terrace.plans import silver as S

    at = dt.datetime(2024, 1, 1)
    row = {"customer_id": "C1", "product_id": "P1", "ordered_at": "2024-01-01 00:00:00", "quantity": "2", "unit_price": "3.10", "discount_pct": "0.05",
           "channel": "WEB", "status": "N", "currency": "USD"}
    odd = [{}, {"discount_pct": None}, {"status": None}, {"quantity": "0"}, {"quantity": "two"}, {"quantity": None}, {"unit_price": "-1"}, {"unit_price": None},
           {"unit_price": "1.0000001"}, {"unit_price": "9" * 15, "quantity": "9" * 9}, {"discount_pct": "x"}, {"customer_id": "C9"}, {"customer_id": None}, {"product_id": "P9"},
           {"product_id": None, "customer_id": "C9", "quantity": "-1"}, {"ordered_at": "never"}]
    rows = [{"order_id": f"O{i}", **row, **o} for i, o in enumerate(odd)] + [{"order_id": k, **row} for k in (None, None, "", " ", "O0")]
    rows = [{**r, "_source_file": "f", "_batch_id": "b", "_ingested_at": at, "_record_hash": f"{i:064x}", "_bronze_record_id": f"{i:064x}"} for i, r in enumerate(rows)]
    text = ", ".join(f"{c} {'timestamp_ntz' if c == '_ingested_at' else 'string'}" for c in rows[0])
    bronze = spark.createDataFrame([tuple(r.values()) for r in rows], text)
    customers = spark.createDataFrame([("C1", True), ("C9", False)], "customer_id string, is_current boolean")
    return S.orders_checked(bronze, customers, spark.createDataFrame([("P1",)], "product_id string"))


def test_sales_by_a_filter_a_rule_are_the_rows_without_a_reason(spark):
    from terrace.plans import silver as S

    checked = _checked(spark)
    want, got = S.sales_rows(S.orders_classified(checked)), S.sales_of_checked(checked)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    kept = [r.order_id for r in want.collect()]
    assert {"O0", "O1", "O2"} <= set(kept) and not {"O3", "O4", "O11", "O12", "O14", "", None} & set(kept)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_mart_that_counts_orders_sends_neither_their_ids_nor_invalid_rows_to_its_joins(spark):
    from terrace.registry import QUERIES

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = QUERIES["daily_sales"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above = plan[: plan.index("Window [row_number() windowspecdefinition(order_id")]
    assert not re.search(r"Project \[[^\n]*order_id#", above) and "LeftOuter" not in above
    assert "Filter" in above.splitlines()[-2] and "quantity" in above.splitlines()[-2]


def test_the_fact_joins_each_dimension_once_with_the_rows_of_two_joins(spark):
    from terrace.plans import gold as G
    from terrace.plans import silver as S
    from terrace.registry import World

    w = World(spark, SF_SMALL)
    twice = G.fact_sales(S.sales_of_checked(w.orders_checked()), w.dim_customer(), w.dim_product())
    assert [(f.name, f.dataType) for f in w.fact().schema] == [(f.name, f.dataType) for f in twice.schema]
    assert sorted(map(str, w.fact().collect())) == sorted(map(str, twice.collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = World(spark, SF_SMALL).daily()._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above = plan[: plan.index("Window [row_number() windowspecdefinition(order_id")]
    assert len(re.findall(r"\bJoin ", above)) == 2


def test_reference_flags_show_columns_of_the_matched_rows(spark):
    from terrace.operators import rules as R

    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "k string, v int")
    keys = spark.createDataFrame([("a", 10), ("a", 10), (None, 11), ("c", 12)], "k string, n int")
    rows = R.reference_flags(df, {"_known": (keys, "k")}, shown={"_known": ["n"]}).orderBy("v").collect()
    assert [tuple(r) for r in rows] == [("a", 1, True, 10), ("b", 2, None, None), (None, 3, None, None), ("a", 4, True, 10)]


def test_the_fact_is_named_by_the_ids_it_was_joined_by(spark):
    from terrace.registry import QUERIES, World

    w = World(spark, SF_SMALL)
    looked_up = w.fact().join(w.dim_customer().select("customer_key", "customer_id"), "customer_key").join(w.dim_product().select("product_key", "product_id"), "product_key")
    want = looked_up.drop("sales_key", "customer_key", "product_key")
    got = QUERIES["fact_sales"](spark, SF_SMALL)
    assert got.columns == want.columns and got.count() > 1000
    assert sorted(map(str, got.select("order_id", "customer_id", "product_id").collect())) == sorted(map(str, want.select("order_id", "customer_id", "product_id").collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    above = plan[: plan.index("Window [row_number() windowspecdefinition(order_id")]
    assert len(re.findall(r"\bJoin ", above)) == 2
