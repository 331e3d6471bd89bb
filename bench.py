"""Benchmark: the lakehouse pipeline and headline queries on the driver tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

Pipeline stages write real Parquet tables into a fresh folder under the
session's checkpoint directory, as a production run would; headline queries
are the registered ones, executed to completion with the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from terrace.plans import lakehouse as L  # noqa: E402
from terrace.registry import QUERIES  # noqa: E402
from terrace.session import fresh_path, local_session  # noqa: E402
from terrace.sources import fixtures as X  # noqa: E402

HEADLINE = [
    "latest_per_key",
    "orders_quarantine",
    "scd2_apply",
    "merge_upsert_sales",
    "daily_sales",
    "customer_360",
    "product_performance",
]
BRONZE_PARTITIONS = {"customers": ["_ingestion_date"], "products": ["_ingestion_date"]}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="terrace-bench")
    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return out

    lake = L.Lakehouse(fresh_path(spark, "bench-lake"))
    day1 = {
        "customers": X.bronze_customers(spark, sf_dir, 1),
        "products": X.bronze_products(spark, sf_dir, 1),
        "orders": X.bronze_orders(spark, sf_dir),
    }
    ingest = timed("bronze_ingest", lambda: L.run_bronze(spark, lake, day1, BRONZE_PARTITIONS))
    replay = timed("bronze_replay", lambda: L.run_bronze(spark, lake, day1, BRONZE_PARTITIONS))
    assert all(r["rows_inserted"] == 0 for r in replay), replay
    timed("silver_day1", lambda: L.run_silver(spark, lake, "19990101T000000Z", X.DAY1))
    day2 = {
        "customers": X.bronze_customers(spark, sf_dir, 2),
        "products": X.bronze_products(spark, sf_dir, 2),
    }
    timed("bronze_day2", lambda: L.run_bronze(spark, lake, day2, BRONZE_PARTITIONS))
    timed("silver_day2", lambda: L.run_silver(spark, lake, "19990102T000000Z", X.DAY2))
    gold = timed("gold", lambda: L.run_gold(spark, lake, X.DAY2))
    for q in ("daily_trend", "top_customers", "best_products", "channel_mix"):
        timed(f"bq_{q}", lambda q=q: L.ask(spark, lake, q).collect())
    for name in HEADLINE:
        timed(name, lambda name=name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "pipeline_and_headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else None,
                "cpus": cpus,
                "rows": {"bronze": ingest, "gold": gold["rows"]},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
