"""Latest-row-per-key and set difference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Default recency order of Bronze rows: newest ingestion first, record hash
# as the tie-break (total for distinct rows; identical rows are interchangeable).
DEFAULT_ORDER = ("_ingested_at", "_record_hash")


def _hash_bytes(column: str) -> Column:
    """A SHA-256 in lower-case hex as its 32 bytes, which order as the 64 digits do; any other text as its own bytes."""
    return F.when(F.col(column).rlike("^[0-9a-f]{64}$"), F.unhex(column)).otherwise(F.col(column).cast("binary"))


def _order(order_by: Sequence[str | Column] | None) -> list[Column]:
    if order_by:
        return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order_by]
    # half the bytes of the hash go through the shuffle where nothing after it shows the hash itself
    return [F.col("_ingested_at").desc_nulls_last(), _hash_bytes("_record_hash").desc_nulls_last()]


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    keep_null_keys: bool = True,
    null_identity: str | None = None,
) -> DataFrame:
    """Keep the newest row per business key.

    ``row_number() = 1`` over ``partitionBy(key)`` is planned by Spark as a
    partial ``WindowGroupLimit`` *before* the shuffle and a final one after it,
    so every map task already reduces a key to one row: a key holding a third of
    all rows ships at most one row per map task, not the whole group.

    String ``order_by`` entries sort descending (newest first). Rows whose key is
    NULL are not collapsed into one "NULL group" (that would silently lose
    evidence): with ``keep_null_keys`` they are partitioned by their record
    identity (``null_identity``, default ``_bronze_record_id`` or
    ``_record_hash``), so each distinct record passes through for validation to
    reject — still in the same single window pass. Without an identity column
    they are all kept through a second, NULL-filtered scan.
    """
    keys = [key] if isinstance(key, str) else list(key)
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    if null_identity is None:
        null_identity = next((c for c in ("_bronze_record_id", "_record_hash") if c in df.columns), None)
    if keep_null_keys and null_identity is not None:
        partition = [*keys, F.when(~has_key, F.col(null_identity))]
        window = Window.partitionBy(*partition).orderBy(*_order(order_by))
        return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")
    window = Window.partitionBy(*keys).orderBy(*_order(order_by))
    keyed = df.filter(has_key) if keep_null_keys else df
    latest = keyed.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")
    if keep_null_keys:
        latest = latest.unionByName(df.filter(~has_key))
    return latest


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` not present in ``right`` (SQL ``EXCEPT``, NULL-safe)."""
    return left.subtract(right.select(*left.columns))
