"""Slowly changing dimension, type 2, as one plan.

History rows carry ``valid_from``, ``valid_to`` (half-open ``[from, to)``, NULL =
open) and ``is_current``. One ``as_of`` instant closes the old version and opens
the new one, so intervals of a key never overlap; expiry and the new version
come out of the same plan, so no reader sees a key without a current row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, TimestampNTZType

from terrace.functions.normalize import ntz_literal

SCD2_COLUMNS = ["valid_from", "valid_to", "is_current"]


def _ts(as_of: _dt.datetime | Column) -> Column:
    return ntz_literal(as_of)


def first_load(incoming: DataFrame, as_of: _dt.datetime | Column) -> DataFrame:
    """Every incoming row opens its first version at ``as_of``."""
    return incoming.select(
        *incoming.columns,
        _ts(as_of).alias("valid_from"),
        F.lit(None).cast(TimestampNTZType()).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def detect_changes(
    incoming: DataFrame, current: DataFrame, key: str, hash_col: str = "attribute_hash"
) -> DataFrame:
    """Incoming rows that are new keys or whose attribute hash differs from the current version."""
    cur = current.select(F.col(key), F.col(hash_col).alias("_current_hash"))
    joined = incoming.join(cur, on=key, how="left")
    return joined.filter(
        F.col("_current_hash").isNull() | (F.col(hash_col) != F.col("_current_hash"))
    ).drop("_current_hash")


def expire(history: DataFrame, changed_keys: DataFrame, key: str, as_of: _dt.datetime | Column) -> DataFrame:
    """Close the current version of every key in ``changed_keys`` at ``as_of``."""
    flags = changed_keys.select(key).distinct().withColumn("_changed", F.lit(True))
    joined = history.join(flags, on=key, how="left")
    hit = F.col("is_current") & F.col("_changed").isNotNull()
    return joined.select(
        *[c for c in history.columns if c not in ("valid_to", "is_current")],
        F.when(hit, _ts(as_of)).otherwise(F.col("valid_to")).alias("valid_to"),
        F.when(hit, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
    ).select(*history.columns)


def apply_scd2(
    history: DataFrame,
    incoming: DataFrame,
    key: str,
    as_of: _dt.datetime | Column,
    hash_col: str = "attribute_hash",
    opened_flag: str | None = None,
) -> DataFrame:
    """History after applying one delivery.

    * closed versions pass through untouched;
    * current ⟗ incoming (full outer join on the key, the only shuffle):
      - no incoming row or same hash → current version kept;
      - new key → new open version;
      - hash changed → current version closed at ``as_of`` *and* new open version.

    The one-or-two output rows per joined row come from exploding a two-element
    array, so the join is evaluated once. ``incoming`` must hold one row per key
    (dedupe first, else history forks). Keys absent from the delivery stay open.
    With ``opened_flag``, a boolean column of that name marks the versions this
    delivery opened (to count changes without another pass).
    """
    data_cols = [c for c in incoming.columns if c not in SCD2_COLUMNS]
    closed = history.filter(~F.coalesce(F.col("is_current"), F.lit(False)))
    current = history.filter(F.coalesce(F.col("is_current"), F.lit(False)))
    cur = current.select(*[F.col(c).alias(f"_c_{c}") for c in data_cols + SCD2_COLUMNS])
    inc = incoming.select(*[F.col(c).alias(f"_i_{c}") for c in data_cols])
    j = cur.join(inc, F.col(f"_c_{key}") == F.col(f"_i_{key}"), "full_outer")

    has_cur = F.col(f"_c_{key}").isNotNull()
    has_inc = F.col(f"_i_{key}").isNotNull()
    changed = has_inc & (~has_cur | (F.col(f"_i_{hash_col}") != F.col(f"_c_{hash_col}")))
    expired = has_cur & changed
    open_ts = _ts(as_of)

    flag = [F.lit(False).alias(opened_flag)] if opened_flag else []
    new_flag = [F.lit(True).alias(opened_flag)] if opened_flag else []
    old_version = F.struct(
        has_cur.alias("_present"),
        *[F.col(f"_c_{c}").alias(c) for c in data_cols],
        F.col("_c_valid_from").alias("valid_from"),
        F.when(expired, open_ts).otherwise(F.col("_c_valid_to")).alias("valid_to"),
        F.when(expired, F.lit(False)).otherwise(F.col("_c_is_current")).cast(BooleanType()).alias("is_current"),
        *flag,
    )
    new_version = F.struct(
        changed.alias("_present"),
        *[F.col(f"_i_{c}").alias(c) for c in data_cols],
        open_ts.alias("valid_from"),
        F.lit(None).cast(TimestampNTZType()).alias("valid_to"),
        F.lit(True).alias("is_current"),
        *new_flag,
    )
    out_cols = data_cols + SCD2_COLUMNS + ([opened_flag] if opened_flag else [])
    versions = (
        j.select(F.explode(F.array(old_version, new_version)).alias("_v"))
        .filter(F.col("_v._present"))
        .select(*[F.col(f"_v.{c}").alias(c) for c in out_cols])
    )
    return closed.select(*data_cols, *SCD2_COLUMNS, *flag).unionByName(versions)
