import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from terrace.functions import money
from terrace.functions.identity import attribute_hash, record_hash, record_id, surrogate_key
from terrace.functions.normalize import parse_date, parse_timestamp


def test_attribute_hash_keeps_null_positions_and_separators(spark):
    df = spark.createDataFrame(
        [("a", None, "b"), ("a", "b", None), ("a||b", "c", None), ("a", "b||c", None)], "x string, y string, z string"
    )
    hashes = [r.h for r in df.select(attribute_hash(["x", "y", "z"]).alias("h")).collect()]
    assert len(set(hashes)) == 4


def test_record_id_is_stable_per_file_and_content(spark):
    df = spark.createDataFrame([("f1", "a"), ("f1", "a"), ("f2", "a")], "f string, v string")
    out = df.select(record_id("f", record_hash(["v"])).alias("id")).collect()
    assert out[0].id == out[1].id != out[2].id


def test_surrogate_key_is_non_negative(spark):
    df = spark.range(0, 5000).select(F.col("id").cast("string").alias("k"))
    out = df.select(F.xxhash64("k").alias("raw"), surrogate_key("k").alias("key"))
    assert out.filter(F.col("raw") < 0).count() > 0  # the mask matters
    assert out.filter(F.col("key") < 0).count() == 0
    assert out.select("key").distinct().count() == 5000


def test_rounded_average_half_away_from_zero(spark):
    rows = [("p", Decimal("0.01")), ("p", Decimal("0.02")), ("n", Decimal("-0.01")), ("n", Decimal("-0.02")),
            ("e", None)]
    df = spark.createDataFrame(rows, "g string, v decimal(18,2)")
    got = {r.g: r.a for r in df.groupBy("g").agg(money.rounded_average("v").alias("a")).collect()}
    assert got == {"p": Decimal("0.02"), "n": Decimal("-0.02"), "e": None}


def test_value_band_bounds(spark):
    df = spark.createDataFrame([(Decimal("1000.00"),), (Decimal("999.99"),), (Decimal("300.00"),),
                                (Decimal("299.99"),), (None,)], "v decimal(18,2)")
    assert [r.b for r in df.select(money.value_band("v").alias("b")).collect()] == [
        "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]


def test_net_uses_unrounded_gross(spark):
    df = spark.createDataFrame([(3, Decimal("0.35"), Decimal("0.1000"))], "q int, p decimal(12,2), d decimal(5,4)")
    r = df.select(money.gross("q", "p").alias("g"), money.net("q", "p", "d").alias("n")).first()
    assert r.g == Decimal("1.05") and r.n == Decimal("0.95")  # 0.945 -> 0.95 (HALF_UP)


def test_unparseable_date_and_time_become_null(spark):
    df = spark.createDataFrame([("not-a-date", "nope"), ("1995-01-02", "1998-01-05 10:00:00")], "d string, t string")
    out = df.select(parse_date(df, "d").alias("d"), parse_timestamp(df, "t").alias("t")).collect()
    assert out[0].d is None and out[0].t is None
    assert out[1].d == dt.date(1995, 1, 2) and out[1].t == dt.datetime(1998, 1, 5, 10, 0)


def test_times_are_utc_in_any_session_zone(spark):
    texts = {"2024-01-02T10:00:00+02:00": (8, 0), "2024-01-02 10:00:00": (10, 0), "2024-01-02T10:00:00Z": (10, 0), "2024-01-02 10:00:00-05:30": (15, 30),
             "2024-01-02 10:00:00 Europe/Paris": (9, 0), "2024-01-02": (0, 0), "nope": None, "10:99:99+02:00": None}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", session)
            df = spark.createDataFrame([(t,) for t in texts], "t string")
            got = {r.t: r.p for r in df.select("t", parse_timestamp(df, "t").alias("p")).collect()}
            assert got == {t: hm and dt.datetime(2024, 1, 2, *hm) for t, hm in texts.items()}
            # an hour that comes twice in New York, as text and as a typed instant
            twice = spark.sql("SELECT '2024-11-03T05:30:00Z' AS t, timestamp_micros(1730611800000000) AS i, '2024-11-03T06:30:00Z' AS u")
            r = twice.select(*[parse_timestamp(twice, c).alias(c) for c in "tiu"]).first()
            assert r.t == r.i == dt.datetime(2024, 11, 3, 5, 30) and r.u == dt.datetime(2024, 11, 3, 6, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_exact_parsing_loses_nothing(spark):
    from pyspark.sql.types import BooleanType, IntegerType

    from terrace.functions.money import PRICE
    from terrace.functions.normalize import exact

    rows = ["1", " 2.50 ", "10.5001", "10.50001", "1e2", "-3", "two", "", None, "1e-9", "0.0000000000000000001", "123456789012345", "2.0", "TRUE", "1.0000000000000000000000"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [tuple(r) for r in df.select(*[exact(F.col("t"), t) for t in (PRICE, IntegerType(), BooleanType())]).collect()]
    money_ = [Decimal(x) if x else None for x in ("1", "2.5", "10.5001", None, "100", "-3", None, None, None, None, None, None, "2", None, "1")]
    assert [g[0] for g in got] == money_
    assert [g[1] for g in got] == [1, None, None, None, 100, -3, None, None, None, None, None, None, 2, None, 1]
    assert [g[2] for g in got] == [None] * 13 + [True, None]
