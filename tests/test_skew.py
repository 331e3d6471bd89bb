"""A key holding a third of all rows: results stay exact and plans keep the
skew-safe shapes (partial window limit, partial aggregation, no single-group task)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from terrace.functions.identity import attribute_hash
from terrace.operators.dedupe import latest_per_key
from terrace.operators.merge import upsert
from terrace.operators.rank import dense_rank_within, dense_rank_window
from terrace.plans import gold as G

N = 30000


def _orders(spark):
    # a third of all rows belong to customer C1 and to order id HOT (re-deliveries)
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("O"), F.col("id").cast("string"))).alias(
            "order_id"),
        F.when(F.col("id") % 3 == 0, F.lit("C1")).otherwise(F.concat(F.lit("C"), (F.col("id") % 50).cast("string"))).alias(
            "customer_id"),
        F.concat(F.lit("P"), (F.col("id") % 7).cast("string")).alias("product_id"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_interval(secs=F.col("id"))).alias("_ingested_at"),
        F.sha2(F.col("id").cast("string"), 256).alias("_record_hash"),
        F.col("id"),
    )
    return df


def test_hot_key_latest_per_key_is_exact_and_limited_before_shuffle(spark):
    df = _orders(spark)
    latest = latest_per_key(df, "order_id")
    hot = latest.filter(F.col("order_id") == "HOT").collect()
    assert len(hot) == 1 and hot[0].id == max(i for i in range(N) if i % 3 == 0)
    assert latest.count() == 1 + (N - N // 3)
    plan = latest._jdf.queryExecution().sparkPlan().toString()  # noqa: SLF001
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_key_upsert_and_marts(spark):
    sales = latest_per_key(_orders(spark), "order_id").select(
        "order_id", "customer_id", "product_id",
        F.lit(dt.date(2024, 1, 1)).alias("order_date"), F.col("_ingested_at").alias("ordered_at"),
        F.lit(2).alias("quantity"), F.lit(Decimal("3.00")).cast("decimal(18,2)").alias("gross_amount"),
        F.lit(Decimal("0.00")).cast("decimal(18,2)").alias("discount_amount"),
        F.lit(Decimal("3.00")).cast("decimal(18,2)").alias("net_amount"), F.lit("WEB").alias("channel"),
        F.lit("COMPLETED").alias("status"), F.lit("USD").alias("currency"),
    )
    changed = sales.filter(F.col("customer_id") == "C1").withColumn("status", F.lit("RETURNED"))
    merged = upsert(sales, changed, "order_id")
    assert merged.count() == sales.count()
    assert merged.filter("status = 'RETURNED'").count() == sales.filter(F.col("customer_id") == "C1").count() > 1

    customers = spark.range(50).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_id"))
    customers = customers.union(spark.createDataFrame([("C1",)], "customer_id string")).distinct()
    hist = customers.select("customer_id", *[F.lit("x").alias(c) for c in
                                             ("full_name", "email", "city", "country", "segment")],
                            F.lit(None).cast("date").alias("signup_date"),
                            F.lit(None).cast("timestamp_ntz").alias("valid_from"), F.lit(True).alias("is_current"))
    products = spark.range(7).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_id"),
                                     F.lit("n").alias("product_name"), F.lit("cat").alias("category"),
                                     F.lit(Decimal("1.00")).cast("decimal(12,2)").alias("unit_cost"),
                                     F.lit(Decimal("2.00")).cast("decimal(12,2)").alias("list_price"),
                                     F.lit(True).alias("active"))
    dc, dp = G.dim_customer(hist), G.dim_product(products)
    fact = G.fact_sales(merged, dc, dp)
    c360 = G.customer_360(fact, dc, dt.date(2024, 2, 1))
    assert c360.agg(F.sum("lifetime_orders")).first()[0] == fact.count() == merged.count()
    daily = G.daily_sales(fact)
    assert daily.first().orders == fact.count()
    plan = daily._jdf.queryExecution().sparkPlan().toString()  # noqa: SLF001
    assert "partial_count" in plan  # map-side partial aggregation before the shuffle


def test_one_category_holds_most_products_rank_is_distributed(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 8, F.lit("big")).otherwise(F.lit("small")).alias("category"),
        (F.col("id") % 997).cast("decimal(18,2)").alias("net_revenue"),
        F.col("id"),
    )
    ranked = dense_rank_within(df, "category", "net_revenue", "r")
    want = dense_rank_window(df, "category", "net_revenue", "r")
    assert ranked.select("id", "r").exceptAll(want.select("id", "r")).count() == 0
    plan = ranked._jdf.queryExecution().sparkPlan().toString()  # noqa: SLF001
    assert "dense_rank" not in plan.lower()  # no window over whole categories


def test_attribute_hash_for_skewed_scd2_is_stable(spark):
    df = spark.createDataFrame([("a", None)] * 5, "x string, y string")
    assert df.select(attribute_hash(["x", "y"]).alias("h")).distinct().count() == 1


def _split_joins(spark, df):
    """The final plan of ``df`` after a run with no broadcast and small partitions."""
    import contextlib

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    with contextlib.ExitStack() as undo:
        for k, v in settings.items():
            undo.callback(spark.conf.unset if before[k] is None else spark.conf.set, *([k] if before[k] is None else [k, before[k]]))
            spark.conf.set(k, v)
        out = df()
        rows = out.collect()
        return rows, out._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def test_reference_join_is_split_at_a_hot_key(spark):
    from terrace.operators import rules as R

    # many partitions on the left, so that a hot partition can be split by its map outputs
    orders = spark.range(0, 60_000, 1, 24).select(
        F.col("id").cast("string").alias("order_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 500).cast("string"))).alias("customer_id")
    )
    keys = spark.range(400).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_id")).union(spark.sql("SELECT 'hot'"))
    rows, plan = _split_joins(spark, lambda: R.reference_flags(orders, {"_customer_exists": (keys.union(keys), "customer_id")}))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == 60_000 and all((r._customer_exists is True) == (r.customer_id == "hot" or int(r.customer_id[1:]) < 400) for r in rows)


def test_rows_without_a_key_are_dealt_to_all_tasks(spark):
    from terrace.operators import rules as R

    orders = spark.range(0, 40_000, 1, 8).select(F.col("id").cast("string").alias("order_id"), F.when(F.col("id") % 50 == 0, F.lit("c1")).alias("customer_id"))
    keys = spark.createDataFrame([("c1",), (None,)], "customer_id string")

    def flagged():
        return R.reference_flags(orders, {"_customer_exists": (keys, "customer_id")}).withColumn("task", F.spark_partition_id())

    rows, _ = _split_joins(spark, flagged)
    held = {}
    for r in rows:
        held[r.task] = held.get(r.task, 0) + 1
        assert r._customer_exists is (True if r.customer_id else None)
    assert len(rows) == 40_000 and max(held.values()) < 12_000
