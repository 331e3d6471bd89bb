"""Merges as pure DataFrame operators (no table format required).

Each returns the rows to write plus, where useful, the merged view. Publishing
is separate (:mod:`terrace.sinks.publish`), so a merge can be audited before it
becomes visible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def insert_only(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str] = "_bronze_record_id",
    scope: Sequence[str] = (),
) -> DataFrame:
    """Source rows whose key is not yet in the target (idempotent append).

    A replayed delivery yields no rows. Duplicates *inside* the source are all
    kept, as an insert-all merge would. NULL keys never match, so such rows are
    inserted.

    ``scope`` names extra columns that the key already determines (e.g. the
    delivery ``batch_date`` of a record id made from the file path). Adding them
    to the join lets a target partitioned by them be pruned to the deliveries
    present in the source (dynamic partition pruning) instead of reading every
    key ever ingested.
    """
    on = list(scope) + _keys(key)
    return source.join(target.select(*on), on=on, how="left_anti")


def insert_only_merged(target: DataFrame, source: DataFrame, key="_bronze_record_id", scope=()) -> DataFrame:
    """Target after the insert-only merge: target ∪ new source rows."""
    new = insert_only(target, source, key, scope)
    return target.unionByName(new.select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Update-all / insert-all by key: target rows whose key is in the source are
    replaced by the source row, the rest are kept, new keys are added.

    The source must hold at most one row per key (dedupe with
    :func:`terrace.operators.dedupe.latest_per_key` and gate with a ``unique``
    check) — a table-format MERGE would raise on several matches, a union would
    silently keep both.

    Plan: ``target ▷ source-keys`` (left anti join) ∪ source. When the source is
    a small increment, AQE broadcasts its keys and the target is only scanned.
    """
    keys = _keys(key)
    kept = target.join(source.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(source.select(*target.columns))
