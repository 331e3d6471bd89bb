import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lake_testing import SF_SMALL
from terrace.operators import quality as Q
from terrace.operators.rank import dense_rank_within, dense_rank_window


def test_checks_in_one_frame(spark):
    df = spark.createDataFrame([("a", 1), ("a", -1), (None, 0), (None, None)], "k string, v int")
    res = Q.run_checks(df, [Q.not_null("k"), Q.unique("k"), Q.non_negative("v"), Q.positive("v")])
    got = {r.name: (r.passed, r.actual) for r in res.collect()}
    assert got == {"k_not_null": (False, 2), "k_unique": (False, 2), "v_non_negative": (False, 1),
                   "v_positive": (False, 2)}


def test_gate_raises_after_writing_evidence(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    ev = Q.report(Q.run_checks(df, [Q.unique("k"), Q.not_null("k")]), "silver")
    assert not ev["passed"]
    with pytest.raises(Q.QualityGateError, match="k_unique"):
        Q.gate(spark, ev, str(tmp_path / "silver_quality.json"))
    import json

    written = json.loads((tmp_path / "silver_quality.json").read_text())
    assert written["passed"] is False and written["stage"] == "silver"


def test_quarantine_rate(spark):
    df = spark.createDataFrame([(None,)] * 19 + [("X",)], "_quarantine_reason string")
    r = Q.quarantine_rate(df, 0.05).first()
    assert r.rows == 20 and r.quarantined == 1 and r.passed
    r = Q.quarantine_rate(df.union(df.limit(1).select(F.lit("Y"))), 0.05).first()
    assert not r.passed


def test_distributed_dense_rank_equals_window(spark):
    rng = random.Random(7)
    rows = [(f"c{rng.randint(0, 3)}", rng.choice([None, *range(30)]), i) for i in range(3000)]
    rows += [("hot", rng.randint(0, 500), 10_000 + i) for i in range(5000)]  # one group holds most rows
    rows += [(None, rng.choice([None, 1, 2]), 20_000 + i) for i in range(50)]  # NULL group and values
    df = spark.createDataFrame(rows, "g string, v int, id int")
    a = dense_rank_within(df, "g", "v", "r").select("id", "r")
    b = dense_rank_window(df, "g", "v", "r").select("id", "r")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rank_over_other_types_and_far_values(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), rng.choice([-1, 1]) * rng.randint(0, 1 << rng.randint(1, 62)), i) for i in range(2000)] + [("a", None, 5000), ("a", -(2**63), 5001), ("b", 2**63 - 1, 5002)]
    longs = spark.createDataFrame(rows, "g string, v long, id int")
    frames = [longs, longs.withColumn("v", F.expr("cast(v as decimal(29,2)) * cast(0.37 as decimal(3,2))").cast("decimal(29,2)")), longs.withColumn("v", F.expr("date_add(date'2000-01-01', cast(v % 4000 as int))")),
              longs.withColumn("v", F.expr("cast(timestamp_micros(v % 4000000000000000) as timestamp_ntz)"))]
    for df in frames:
        for descending in (True, False):
            order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
            want = df.select("id", F.dense_rank().over(Window.partitionBy("g").orderBy(order)).alias("r"))
            got = dense_rank_within(df, "g", "v", "r", descending).select("id", "r")
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(TypeError, match="double"):
        dense_rank_within(longs.withColumn("v", F.rand()), "g", "v", "r")


def test_no_job_runs_before_the_rank_is_asked_for_and_the_fact_is_computed_once(spark):
    from terrace.registry import QUERIES

    sc = spark.sparkContext
    for name in ("product_performance", "bq_best_products"):
        QUERIES[name](spark, SF_SMALL)  # the tables' footers are read by now
        sc.setJobGroup(f"build-{name}", name)
        df = QUERIES[name](spark, SF_SMALL)
        assert list(sc.statusTracker().getJobIdsForGroup(f"build-{name}")) == []
        sc.setJobGroup("rest", "rest")
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]  # noqa: SLF001
        assert final.count("lineitem.parquet") <= 1 and "ReusedExchange" in final


def test_row_checks_and_a_unique_key_need_one_scan(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", -1), (None, 0), (None, None), ("b", 5)], "k string, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    res = Q.run_checks(df, [Q.not_null("k"), Q.unique("k"), Q.non_negative("v"), Q.positive("v")])
    assert res._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1  # noqa: SLF001
    assert [(r.name, r.actual) for r in res.orderBy("_order").collect()] == [("k_not_null", 2), ("k_unique", 2), ("v_non_negative", 1), ("v_positive", 2)]
    none = Q.run_checks(df.filter("false"), [Q.unique("k"), Q.positive("v")]).collect()
    assert [(r.name, r.actual, r.passed) for r in none] == [("k_unique", 0, True), ("v_positive", 0, True)]
