"""Files sent again: those that Bronze holds are told by their contents, rows of all others by their ids."""

import datetime as dt
import re

from pyspark.sql import functions as F

from terrace.plans import bronze as B
from terrace.plans import lakehouse as L
from terrace.sources import landing

HEADER = "order_id,customer_id,product_id,ordered_at,quantity,unit_price,discount_pct,channel,status,currency\n"


def _file(root, day, name, ids):
    path = root / f"orders/batch_date={day}/{name}.csv"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(HEADER + "".join(f"{i},C1,P1,{day} 10:00:00,1,2.00,0.0,WEB,COMPLETED,USD\n" for i in ids))


def test_files_sent_again_are_not_compared_and_changed_ones_row_by_row(spark, tmp_path):
    root, lake = tmp_path / "landing", L.Lakehouse(str(tmp_path / "lake"))
    _file(root, "2024-01-01", "a", ["O1", "O2", "O2"])
    _file(root, "2024-01-01", "b", ["O1"])
    _file(root, "2024-01-02", "a", ["O3", "O4"])

    def run(batch):
        found = L.ingest_landing(spark, lake, str(root), batch, entities=["orders"])
        return [(r["rows_seen"], r["rows_inserted"]) for r in found]

    assert run("1") == [(6, 6)]
    held = spark.read.parquet(lake.path("bronze", "orders"))
    assert all(f.endswith(".zstd.parquet") for f in held.inputFiles())
    assert run("2") == [(6, 0)]
    sent = B.stamped_delivery(spark, str(root), "orders", "3")
    again = B.new_records(held, sent)
    assert again.collect() == []
    plan = again._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert re.search(r"BroadcastHashJoin \[[^\]]*_source_file", plan)
    _file(root, "2024-01-01", "a", ["O2", "O2", "O1"])  # the same rows in another order
    _file(root, "2024-01-01", "b", ["O5", "O5"])
    _file(root, "2024-01-02", "a", ["O3", "O4", "O3"])  # one row more of a record that is there
    sent = B.stamped_delivery(spark, str(root), "orders", "4")
    files = {tuple(r._source_file.split("/")[-2:]) for r in B.replayed_files(held, sent).collect()}
    assert files == {("batch_date=2024-01-01", "a.csv")}
    assert run("5") == [(8, 2)]
    fresh = spark.read.parquet(lake.path("bronze", "orders")).filter("_batch_id = '5'")
    assert [r.order_id for r in fresh.collect()] == ["O5", "O5"]


def test_rows_without_an_id_or_a_file_are_always_new(spark):
    schema = "batch_date date, _source_file string, _bronze_record_id string"
    day = dt.date(2024, 1, 1)
    rows = [(day, "a", "1"), (day, "a", None), (day, None, "2"), (day, "b", "3"), (None, "c", "4")]
    held, sent = spark.createDataFrame(rows, schema), spark.createDataFrame([*rows, (day, None, "5")], schema)
    assert {(r._source_file, r._bronze_record_id) for r in B.new_records(held, sent).collect()} == {("a", None), ("c", "4"), (None, "5")}


def test_a_compressed_delivery_in_small_files_reads_back_whole(spark, tmp_path):
    df = spark.range(25).select(*[F.concat(F.lit(f"{c[0]} "), F.col("id").cast("string")).alias(c) for c in HEADER.strip().split(",")], F.lit(dt.date(2024, 1, 1)).alias("batch_date"))
    landing.write_delivery(df, str(tmp_path), "orders", compression="gzip", rows_per_file=10)
    files = [*(tmp_path / "orders/batch_date=2024-01-01").glob("*.csv.gz")]
    assert len(files) >= 3
    back = landing.scan(spark, str(tmp_path), "orders", with_source_file=False).select(*df.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
