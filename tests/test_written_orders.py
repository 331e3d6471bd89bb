"""Queries that make several results of the orders write what they read again, and check keys without shuffling the rows."""

import re
import time

import pytest
from lake_testing import SF_SMALL
from pyspark.sql import functions as F

from terrace.operators import rules as R


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001


def _texts(df) -> list[str]:
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("most", [0, 1, 500])
def test_flags_of_a_written_frame_are_those_of_the_join(spark, monkeypatch, most):
    from terrace.registry import _staged

    monkeypatch.setattr(R, "BROADCAST_KEYS", most)
    rows = [("a", "x", 1), ("a", None, 2), (None, "x", 3), (None, None, 4), ("u", "x", 5), ("v", "y", 6), ("", "y", 7), ("a", "x", 1)] + [("hot", "x", k) for k in range(50)]
    df = spark.createDataFrame(rows, "c string, p string, v int")
    known = spark.createDataFrame([("a",), ("a",), (None,), ("spare",), ("",)], "c string")
    parts = spark.createDataFrame([("x", 10), ("x", 10), (None, 11)], "p string, n int")
    references = {"_c": (known, "c"), "_p": (parts, "p")}
    for shown in (None, {"_p": ["n"]}):
        want = R.reference_flags(df, references, shown=shown)
        got = R.reference_flags(df, references, shown=shown, written=_staged)
        assert got.columns == want.columns and _texts(got) == _texts(want)
    none = R.reference_flags(df, {"_c": (known.filter("false"), "c")}, written=_staged)
    assert none.count() == len(rows) and none.filter("_c is not null").isEmpty()
    assert R.reference_flags(df.filter("false"), references, written=_staged).isEmpty()


def test_rows_that_meet_a_short_list_of_unknown_keys_are_not_shuffled(spark):
    from terrace.registry import _staged

    df = _staged(spark.range(1000).select((F.col("id") % 7).cast("string").alias("c"), "id"), "rows")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        flagged = R.reference_flags(df, {"_c": (spark.range(5).select(F.col("id").cast("string").alias("c")), "c")}, written=_staged)
        plan = flagged._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and not re.search(r"\bExchange\b", plan)
    assert flagged.filter("_c").count() == sum(k % 7 < 5 for k in range(1000))


def test_the_shuffle_files_of_a_written_frame_are_gone(spark):
    from terrace.registry import _staged

    files = lambda: {str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}  # noqa: E731, SLF001
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    had, before = files(), spark.conf.get(setting)
    held = _staged(spark.range(1000).repartition(3, "id"), "dealt")
    for _ in range(100):
        if not files() - had:
            break
        time.sleep(0.1)
    assert not files() - had and spark.conf.get(setting) == before
    assert held.count() == 1000


def test_the_upsert_of_sales_reads_written_sales(spark):
    from terrace import registry as Q

    w = Q.World(spark, SF_SMALL)
    o_all = w.bronze_orders()
    o1, _ = Q.X.split_at_cutoff(o_all)
    want = Q.money_as_double(Q.upsert(w.sales(o1), w.sales(o_all), "order_id"))
    got = Q.QUERIES["merge_upsert_sales"](spark, SF_SMALL)
    assert got.columns == want.columns and _texts(got) == _texts(want)
    assert len(re.findall(r"\bJoin ", _plan(got))) == 1 and "Window" not in _plan(got)


def test_the_quarantine_of_two_runs_reads_written_rows(spark):
    from terrace import registry as Q

    w = Q.World(spark, SF_SMALL)
    o_all = w.bronze_orders()
    o1, _ = Q.X.split_at_cutoff(o_all)
    stored, again = Q.S.orders_quarantine(w.orders_classified(o1), Q.AS_OF_DATE), Q.S.orders_quarantine(w.orders_classified(o_all), Q.X.DAY2.date())
    want = Q.insert_only_merged(stored, again, "_quarantine_id")
    got = Q.QUERIES["quarantine_idempotent"](spark, SF_SMALL)
    assert got.columns == want.columns and _texts(got) == _texts(want)
    assert len(re.findall(r"\bJoin ", _plan(got))) == 1 and "Window" not in _plan(got)


def test_the_marts_of_the_summary_are_made_of_written_orders_without_joins(spark):
    from terrace.registry import World

    w, plain = World(spark, SF_SMALL), World(spark, SF_SMALL)
    w.stage_orders()
    for got, want in ((w.fact(), plain.fact()), (w.sales(), plain.sales()), (w.quarantine_all(), plain.quarantine_all())):
        assert got.columns == want.columns and _texts(got) == _texts(want)
    assert not re.search(r"\bJoin |\bWindow ", _plan(w.fact()))
