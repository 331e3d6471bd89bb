"""Bronze: scan deliveries, stamp lineage, insert only unseen records."""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.lineage import with_lineage
from terrace.operators.merge import insert_only
from terrace.sources import landing
from terrace.sources.contracts import PARTITION_COLUMN, SOURCE_SYSTEMS

ENTITIES = ("customers", "products", "orders")
SOURCE_FILE, RECORD_ID = "_source_file", "_bronze_record_id"
#: Hashes in hex are most of a Bronze row; of this codec they take half the bytes.
COMPRESSION = "zstd"


def stamped_delivery(
    spark: SparkSession,
    landing_root: str,
    entity: str,
    batch_id: str,
    as_of: _dt.datetime | None = None,
    since: str | _dt.date | None = None,
) -> DataFrame:
    """Scan one entity's deliveries and stamp lineage; ``batch_date`` is carried
    (outside the record hash) so the delivery date survives into Bronze."""
    raw = landing.scan(spark, landing_root, entity, since=since)
    return with_lineage(raw, SOURCE_SYSTEMS[entity], batch_id, ingested_at=as_of)


def delivery_dates(spark: SparkSession, landing_root: str, entity: str, since: str | _dt.date | None = None) -> list[str]:
    """The ``batch_date`` values of an entity's landing folders, from the file listing alone: no job, no row is read."""
    files = landing.scan(spark, landing_root, entity, with_source_file=False).inputFiles()
    dates = {unquote(m[1]) for f in files if (m := re.search(rf"/{PARTITION_COLUMN}=([^/]+)/", f))}
    return sorted(d for d in dates if since is None or d >= str(since))


def file_contents(rows: DataFrame) -> DataFrame:
    """Per delivery date and source file: number of rows and a 128-bit sum of hashes of their record ids, in any order.

    The hashes are added up in halves, which no file is long enough to overflow. Files with a row of no id are left out.
    """
    hashes = [F.xxhash64(RECORD_ID), F.xxhash64(F.lit(1), RECORD_ID)]
    halves = [half for h in hashes for half in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    sums = [F.sum(half).alias(f"_sum{i}") for i, half in enumerate(halves)]
    found = rows.groupBy(PARTITION_COLUMN, SOURCE_FILE).agg(F.count(F.lit(1)).alias("_rows"), F.count(RECORD_ID).alias("_ids"), *sums)
    return found.filter("_rows = _ids").drop("_ids")


def replayed_files(target: DataFrame, delivery: DataFrame) -> DataFrame:
    """``(batch_date, _source_file)`` of the files whose rows, all of them and no others, Bronze holds already."""
    held, sent = file_contents(target), file_contents(delivery)
    return sent.join(held, sent.columns, "left_semi").select(PARTITION_COLUMN, SOURCE_FILE)


def new_records(target: DataFrame, delivery: DataFrame, dates: Sequence[str] | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Delivery rows whose record identity is not in Bronze yet.

    Bronze is partitioned by the delivery ``batch_date``, which the record id
    (built from the file path) determines. The target is therefore restricted to
    the delivery dates present in this run — a few partition values, ``dates`` from
    the landing listing (:func:`delivery_dates`) or else a distinct over the delivery —
    so the merge reads only those Bronze partitions instead of every record id ever
    ingested (Spark's dynamic partition pruning does not prune the build side of an
    anti join).

    A record id is made from the file and the row, so rows of a file can only meet rows of that file. Files sent again
    as they were are found from a number of rows and a sum a file (:func:`replayed_files`), and left out on both
    sides before the records of all others are shuffled and compared by id. ``counted`` is the delivery without what
    must not run twice (an observation). The list of such files is broadcast: a row a file, as in the file
    listing that the driver holds anyway.
    """
    if PARTITION_COLUMN in delivery.columns and PARTITION_COLUMN in target.columns:
        if dates is None:
            dates = [r[0] for r in delivery.select(PARTITION_COLUMN).distinct().collect()]
        pruned = target.filter(F.col(PARTITION_COLUMN).isin([F.lit(d).cast("date") for d in dates]))
        if SOURCE_FILE in delivery.columns and SOURCE_FILE in target.columns:
            known = F.broadcast(replayed_files(pruned, delivery if counted is None else counted))
            pruned, delivery = (df.join(known, [PARTITION_COLUMN, SOURCE_FILE], "left_anti") for df in (pruned, delivery))
        return insert_only(pruned, delivery, RECORD_ID, scope=[PARTITION_COLUMN])
    return insert_only(target, delivery, RECORD_ID)


def ingest_counts(entity: str, delivery: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row: entity, rows seen in the scan, rows inserted."""
    tagged = delivery.select(F.lit(1).alias("_s"), F.lit(0).alias("_i")).unionByName(
        inserted.select(F.lit(0).alias("_s"), F.lit(1).alias("_i"))
    )
    return tagged.agg(
        F.lit(entity).alias("entity"),
        F.coalesce(F.sum("_s"), F.lit(0)).cast("bigint").alias("rows_seen"),
        F.coalesce(F.sum("_i"), F.lit(0)).cast("bigint").alias("rows_inserted"),
    )
