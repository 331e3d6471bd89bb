import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from terrace.sources import landing
from terrace.streaming.ingest import start_bronze_ingest

SCHEMA = ("order_id string, customer_id string, product_id string, ordered_at string, quantity int, "
          "unit_price decimal(12,2), discount_pct decimal(5,4), channel string, status string, currency string, "
          "batch_date string")


def _delivery(spark, day, ids):
    rows = [(i, "C1", "P1", f"{day} 10:00:00", 1, Decimal("2"), Decimal("0"), "WEB", "COMPLETED", "USD", day) for i in ids]
    return spark.createDataFrame(rows, SCHEMA).withColumn("batch_date", F.col("batch_date").cast("date"))


def _run(spark, root, bronze, ckpt):
    q = start_bronze_ingest(spark, root, bronze, "orders", ckpt, as_of=dt.datetime(2024, 1, 3))
    q.awaitTermination()
    return spark.read.parquet(bronze)


def test_incremental_ingest_is_idempotent(spark, tmp_path):
    root, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    landing.write_delivery(_delivery(spark, "2024-01-01", ["O1", "O2"]), root, "orders")
    assert _run(spark, root, bronze, str(tmp_path / "ck1")).count() == 2
    landing.write_delivery(_delivery(spark, "2024-01-02", ["O2", "O3"]), root, "orders")
    out = _run(spark, root, bronze, str(tmp_path / "ck1"))  # only the new delivery is read
    assert out.count() == 4
    assert out.select("_bronze_record_id").distinct().count() == 4
    # a lost checkpoint replays every file: the insert-only merge adds nothing
    assert _run(spark, root, bronze, str(tmp_path / "ck2")).count() == 4
