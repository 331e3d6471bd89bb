import datetime as dt

from pyspark.sql import functions as F

from lake_testing import plan_text
from terrace.operators.dedupe import latest_per_key, set_difference
from terrace.operators.merge import insert_only, insert_only_merged, upsert

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
SCHEMA = "k string, v string, _ingested_at timestamp_ntz, _record_hash string"


def test_latest_per_key_newest_then_hash(spark):
    rows = [("a", "old", T1, "z"), ("a", "new", T2, "a"), ("b", "h1", T1, "1"), ("b", "h2", T1, "2")]
    out = {r.k: r.v for r in latest_per_key(spark.createDataFrame(rows, SCHEMA), "k").collect()}
    assert out == {"a": "new", "b": "h2"}


def test_null_keys_bypass_dedupe(spark):
    rows = [(None, "x", T1, "1"), (None, "y", T1, "2"), ("a", "v", T1, "3")]
    out = latest_per_key(spark.createDataFrame(rows, SCHEMA), "k")
    assert out.count() == 3


def test_latest_per_key_plans_partial_window_group_limit(spark):
    rows = [("a", "x", T1, "1")]
    df = latest_per_key(spark.createDataFrame(rows, SCHEMA), "k")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan
    assert "WindowGroupLimit" in df._jdf.queryExecution().sparkPlan().toString()  # noqa: SLF001


def test_set_difference_is_distinct_and_null_safe(spark):
    left = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "k string, v string")
    right = spark.createDataFrame([("b", "x")], "k string, v string")
    assert [tuple(r) for r in set_difference(left, right).collect()] == [("a", None)]


def test_insert_only_replay_adds_nothing(spark):
    tgt = spark.createDataFrame([("id1", 1), ("id2", 2)], "_bronze_record_id string, v int")
    src = spark.createDataFrame([("id1", 1), ("id3", 3), ("id3", 3), (None, 4)], "_bronze_record_id string, v int")
    new = insert_only(tgt, src)
    assert sorted((r.v for r in new.collect())) == [3, 3, 4]  # in-source duplicates and NULL keys inserted
    merged = insert_only_merged(tgt, src)
    # Replay of the same delivery adds nothing except rows without an identity (NULL never
    # matches, as in a MERGE on t.k = s.k); Bronze record ids are never NULL.
    assert [r.v for r in insert_only(merged, src).collect()] == [4]
    assert insert_only(merged, src.filter("_bronze_record_id IS NOT NULL")).count() == 0


def test_insert_only_into_empty_target(spark):
    tgt = spark.createDataFrame([], "_bronze_record_id string, v int")
    src = spark.createDataFrame([("id1", 1)], "_bronze_record_id string, v int")
    assert insert_only(tgt, src).count() == 1


def test_upsert_replaces_keeps_and_inserts(spark):
    tgt = spark.createDataFrame([("k1", "old"), ("k2", "keep")], "k string, v string")
    src = spark.createDataFrame([("k1", "new"), ("k3", "add")], "k string, v string")
    out = {r.k: r.v for r in upsert(tgt, src, "k").collect()}
    assert out == {"k1": "new", "k2": "keep", "k3": "add"}
    again = upsert(upsert(tgt, src, "k"), src, "k")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, upsert(tgt, src, "k").collect()))


def test_upsert_into_empty_target(spark):
    tgt = spark.createDataFrame([], "k string, v string")
    src = spark.createDataFrame([("k1", "a")], "k string, v string")
    assert upsert(tgt, src, "k").count() == 1


def test_upsert_small_source_does_not_shuffle_target(spark):
    tgt = spark.range(0, 200000).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"))
    src = spark.createDataFrame([("1", "x")], "k string, v string")
    out = upsert(tgt, src, "k")
    out.collect()
    assert "BroadcastHashJoin" in plan_text(out)


def test_null_key_rows_of_one_record_are_one_row(spark):
    rows = [(None, "x", T1, "1"), (None, "x", T1, "1"), (None, "y", T1, "2")]
    assert latest_per_key(spark.createDataFrame(rows, SCHEMA), "k").count() == 2
    plain = spark.createDataFrame([(None, "x"), (None, "x")], "k string, v string")
    assert latest_per_key(plain, "k", order_by=["v"]).count() == 2  # no identity column: all kept
