"""Landing-zone scans (CSV / NDJSON) through the source contracts.

The whole entity directory is read with ``basePath`` so ``batch_date`` becomes a
real partition column: a ``since`` filter on it prunes whole deliveries at
listing time instead of rescanning every landing partition.

CSV is read with ``enforceSchema=false``: Spark then checks the header against
the contract and fails on a re-ordered or renamed header instead of binding
values to the wrong columns by position.

Every value is read as the text that the file holds (a JSON number with all its
digits); nothing is parsed, rounded or lost before Bronze.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.sources.contracts import CONTRACTS, CORRUPT, FORMATS, PARTITION_COLUMN, landing_schema


def entity_path(landing_root: str, entity: str) -> str:
    return f"{landing_root.rstrip('/')}/{entity}"


def scan(
    spark: SparkSession,
    landing_root: str,
    entity: str,
    since: str | _dt.date | None = None,
    with_source_file: bool = True,
) -> DataFrame:
    """Read every delivery of ``entity`` under ``landing_root``.

    Returns the contract columns as text, ``_corrupt_record`` (the whole line where it
    has another number of CSV fields or is no JSON object; else NULL), ``batch_date`` and
    (optionally) ``_source_file`` taken from the hidden ``_metadata.file_path`` column.
    A short CSV line keeps the values it has; the columns of a broken JSON line are NULL.
    """
    path = entity_path(landing_root, entity)
    reader = spark.read.schema(landing_schema(entity)).option("basePath", path).option("columnNameOfCorruptRecord", CORRUPT)
    fmt = FORMATS[entity]
    if fmt == "csv":
        df = (
            reader.option("header", True)
            .option("enforceSchema", False)
            .option("mode", "PERMISSIVE")
            .csv(path)
        )
    elif fmt == "json":
        df = reader.option("mode", "PERMISSIVE").json(path)
    else:  # pragma: no cover - contracts only name csv/json
        raise ValueError(f"unknown landing format {fmt!r}")
    if since is not None:
        df = df.filter(F.col(PARTITION_COLUMN) >= F.lit(since).cast("date"))
    if with_source_file:
        df = df.withColumn("_source_file", F.col("_metadata.file_path"))
    return df


def write_delivery(
    df: DataFrame, landing_root: str, entity: str, mode: str = "append", compression: str | None = None, rows_per_file: int = 0
) -> None:
    """Write a delivery in the entity's landing format, one folder per ``batch_date``.

    Used to stage deliveries (tests, replays). Whitespace is written as is so a
    round trip through the landing format is lossless. Files may be compressed; a compressed file
    is read by one task, so ``rows_per_file`` (0: no bound) keeps each of them small.
    """
    columns = [f.name for f in CONTRACTS[entity].fields] + [PARTITION_COLUMN]
    # rows of a day lie together without one task having to write a whole large day
    writer = df.select(*columns).hint("rebalance", PARTITION_COLUMN).write.mode(mode).partitionBy(PARTITION_COLUMN)
    writer = writer.option("maxRecordsPerFile", rows_per_file).option("compression", compression or "none")
    path = entity_path(landing_root, entity)
    if FORMATS[entity] == "csv":
        (
            writer.option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    else:
        writer.option("ignoreNullFields", True).json(path)
