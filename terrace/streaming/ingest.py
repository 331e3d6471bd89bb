"""Incremental Bronze ingestion with Structured Streaming.

The batch form (:mod:`terrace.plans.bronze`) rescans every landing delivery
and relies on the insert-only merge to skip what is already in Bronze. Here the
file source's checkpoint remembers which files were processed, so each run
reads only new deliveries. Each micro-batch is stamped with lineage and merged
insert-only on ``_bronze_record_id``: if a micro-batch is replayed after a
failure (``foreachBatch`` is at-least-once) the merge inserts nothing twice, so
the sink is effectively exactly-once.

``trigger(availableNow=True)`` processes everything present and stops — the
scheduled-batch usage; drop it for a continuously running ingest.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrace.operators.lineage import with_lineage
from terrace.plans.bronze import new_records
from terrace.sinks import publish
from terrace.sources.contracts import CORRUPT, FORMATS, PARTITION_COLUMN, SOURCE_SYSTEMS, landing_schema
from terrace.sources.landing import entity_path


def read_stream(spark: SparkSession, landing_root: str, entity: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of one entity's landing folder through its contract."""
    path = entity_path(landing_root, entity)
    reader = spark.readStream.schema(landing_schema(entity)).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if FORMATS[entity] == "csv":
        df = reader.option("header", True).option("enforceSchema", False).csv(path)
    else:
        df = reader.json(path)
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


def bronze_batch_writer(bronze_path: str, entity: str, batch_prefix: str, as_of: _dt.datetime | None = None):
    """``foreachBatch`` function: stamp lineage, insert-only merge, append."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        stamped = with_lineage(batch, SOURCE_SYSTEMS[entity], f"{batch_prefix}-{epoch_id}", ingested_at=as_of)
        if publish.exists(spark, bronze_path):
            new = new_records(spark.read.parquet(bronze_path), stamped)
        else:
            new = stamped
        publish.append(new, bronze_path, [PARTITION_COLUMN])

    return write


def start_bronze_ingest(
    spark: SparkSession,
    landing_root: str,
    bronze_path: str,
    entity: str,
    checkpoint: str,
    batch_prefix: str = "stream",
    as_of: _dt.datetime | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the incremental ingest of ``entity`` into ``bronze_path``.

    Bronze is partitioned by the delivery ``batch_date``; the merge reads only the
    Bronze partitions of the deliveries in the micro-batch.
    """
    stream = read_stream(spark, landing_root, entity, max_files_per_trigger)
    writer = (
        stream.writeStream.foreachBatch(bronze_batch_writer(bronze_path, entity, batch_prefix, as_of))
        .option("checkpointLocation", checkpoint)
        .queryName(f"bronze_{entity}_ingest")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
