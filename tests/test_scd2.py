import datetime as dt

from pyspark.sql import functions as F

from terrace.functions.identity import attribute_hash
from terrace.operators.scd2 import apply_scd2, detect_changes, expire, first_load

D1, D2, D3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)


def incoming(spark, rows):
    df = spark.createDataFrame(rows, "customer_id string, segment string, signup_date string")
    return df.withColumn("attribute_hash", attribute_hash(["segment"]))


def test_scd2_versions(spark):
    day1 = incoming(spark, [("A", "s1", "d"), ("B", "s1", "d"), ("C", "s1", "d")])
    hist = first_load(day1, D1)
    # A changes segment, B changes only signup_date (no version), C vanishes (stays open), D is new
    day2 = incoming(spark, [("A", "s2", "d"), ("B", "s1", "other"), ("D", "s1", "d")])
    out = apply_scd2(hist, day2, "customer_id", D2)
    rows = sorted((r.customer_id, r.segment, r.valid_from, r.valid_to, r.is_current) for r in out.collect())
    assert rows == [
        ("A", "s1", D1, D2, False), ("A", "s2", D2, None, True),
        ("B", "s1", D1, None, True), ("C", "s1", D1, None, True), ("D", "s1", D2, None, True),
    ]


def test_scd2_invariants_and_replay(spark):
    hist = first_load(incoming(spark, [("A", "s1", "d"), ("B", "s1", "d")]), D1)
    day2 = incoming(spark, [("A", "s2", "d"), ("B", "s3", "d")])
    once = apply_scd2(hist, day2, "customer_id", D2)
    twice = apply_scd2(once, day2, "customer_id", D3)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    day3 = incoming(spark, [("A", "s4", "d")])
    h = apply_scd2(once, day3, "customer_id", D3)
    current = h.filter("is_current").groupBy("customer_id").count()
    assert current.filter(F.col("count") != 1).count() == 0
    # intervals of a key do not overlap; only the last is open
    for key in ("A", "B"):
        versions = sorted((r.valid_from, r.valid_to) for r in h.filter(F.col("customer_id") == key).collect())
        for (f1, t1), (f2, _) in zip(versions, versions[1:]):
            assert t1 == f2
        assert [t for _, t in versions].count(None) == 1


def test_detect_and_expire_match_apply(spark):
    hist = first_load(incoming(spark, [("A", "s1", "d"), ("B", "s1", "d")]), D1)
    day2 = incoming(spark, [("A", "s2", "d"), ("B", "s1", "d"), ("N", "s1", "d")])
    changed = detect_changes(day2, hist.filter("is_current"), "customer_id")
    assert sorted(r.customer_id for r in changed.collect()) == ["A", "N"]
    expired = expire(hist, changed, "customer_id", D2)
    closed = {r.customer_id: (r.valid_to, r.is_current) for r in expired.collect()}
    assert closed == {"A": (D2, False), "B": (None, True)}
