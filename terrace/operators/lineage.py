"""Bronze lineage stamping and record identity (one projection, no shuffle)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.identity import record_hash, record_id
from terrace.functions.normalize import ntz_literal, utc
from terrace.sources.contracts import CORRUPT

LINEAGE_COLUMNS = [
    "_source_system",
    "_source_file",
    "_batch_id",
    "_ingested_at",
    "_ingestion_date",
    "_record_hash",
    "_bronze_record_id",
]


def default_batch_id(now: _dt.datetime | None = None) -> str:
    """Batch id from the UTC clock, ``YYYYMMDDTHHMMSSZ``."""
    now = now or _dt.datetime.now(_dt.UTC)
    return now.strftime("%Y%m%dT%H%M%SZ")


def _as_column(value, cast: str | None = None) -> Column:
    col = value if isinstance(value, Column) else F.lit(value)
    return col.cast(cast) if cast else col


def with_lineage(
    df: DataFrame,
    source_system: str,
    batch_id: str | Column,
    ingested_at: _dt.datetime | Column | None = None,
    source_file: str | Column | None = None,
    source_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Add lineage and identity columns to a source-shaped frame.

    * ``_record_hash``   — SHA-256 of the JSON of the source columns;
    * ``_bronze_record_id`` — SHA-256 of ``source file || record hash``: a replay
      of the same file content gets the same identity;
    * ``_ingested_at`` / ``_ingestion_date`` — a passed-in instant (default: the
      query's ``current_timestamp``, in UTC) so a run is reproducible.

    ``source_file`` defaults to the scan's ``_metadata.file_path`` (or an existing
    ``_source_file`` column). Columns beginning with ``_`` and ``batch_date`` are not
    part of the source row unless named in ``source_columns``; the text of an unreadable
    line (``_corrupt_record``) is, so that two broken lines are two records.
    """
    if source_columns is None:
        source_columns = [c for c in df.columns if not c.startswith("_") and c != "batch_date"]
        source_columns += [CORRUPT] if CORRUPT in df.columns else []
    if source_file is None:
        file_col = F.col("_source_file") if "_source_file" in df.columns else F.col("_metadata.file_path")
    else:
        file_col = _as_column(source_file)
    if ingested_at is None:
        ingested = utc(F.current_timestamp())
    else:
        ingested = ntz_literal(ingested_at)
    base = df.drop(*[c for c in LINEAGE_COLUMNS if c in df.columns and c != "_source_file"])
    stamped = base.select(
        *[F.col(c) for c in base.columns if c != "_source_file"],
        F.lit(source_system).alias("_source_system"),
        file_col.alias("_source_file"),
        _as_column(batch_id, "string").alias("_batch_id"),
        ingested.alias("_ingested_at"),
    )
    hashed = stamped.select(
        "*",
        F.to_date("_ingested_at").alias("_ingestion_date"),
        record_hash(list(source_columns)).alias("_record_hash"),
    )
    return hashed.select("*", record_id("_source_file", "_record_hash").alias("_bronze_record_id"))
