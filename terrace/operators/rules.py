"""Rule validation with reason codes, quarantine projection and referential flags.

A rule is a reason code plus a predicate that is TRUE when the row violates it.
Predicates are made total (``coalesce(p, false)``) in one place, so a NULL
comparison can never make a row vanish from both the valid and the invalid
side. The first violated rule, in list order, names the reason.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

REASON = "_quarantine_reason"
_SPREAD = "_spread"
_UNKNOWN = "_unknown"
#: Unknown keys up to this number (some 40 MB) are broadcast, where their list is used; with more the rows are shuffled.
BROADCAST_KEYS = 500_000


@dataclass(frozen=True)
class Rule:
    reason: str
    violated: Column


def reason_column(rules: Sequence[Rule]) -> Column:
    """First violated rule's reason; NULL when every rule holds."""
    expr = None
    for rule in rules:
        cond = F.coalesce(rule.violated, F.lit(False))
        expr = F.when(cond, F.lit(rule.reason)) if expr is None else expr.when(cond, F.lit(rule.reason))
    return expr if expr is not None else F.lit(None).cast("string")


def classify(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``_quarantine_reason`` (NULL = valid). One projection, no shuffle."""
    return df.withColumn(REASON, reason_column(rules))


def valid_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REASON).isNull()).drop(REASON)


def keeping_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that violate none of the rules: those of :func:`valid_rows` after :func:`classify` by the same rules.

    A condition a rule instead of one over the reason, so that Spark filters by a rule, and drops the columns that nothing
    after it reads, before the joins that this rule does not need.
    """
    for rule in rules:
        df = df.filter(~F.coalesce(rule.violated, F.lit(False)))
    return df


def invalid_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REASON).isNotNull())


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) — together they hold every input row exactly once."""
    c = classify(df, rules)
    return valid_rows(c), invalid_rows(c)


def payload_columns(df: DataFrame, extra: Sequence[str] = ("_source_file", "_batch_id")) -> list[str]:
    """Business columns (no leading ``_``) plus the named technical ones, in frame order."""
    return [c for c in df.columns if (not c.startswith("_") or c in extra) and c != REASON]


def quarantine(
    invalid: DataFrame,
    entity: str,
    quarantine_date: _dt.date | Column,
    payload: Sequence[str] | None = None,
) -> DataFrame:
    """Quarantine rows: entity, reason, date, source file, JSON payload and a
    deterministic ``_quarantine_id`` (so re-running a stage inserts nothing new)."""
    cols = list(payload) if payload is not None else payload_columns(invalid)
    qdate = quarantine_date if isinstance(quarantine_date, Column) else F.lit(quarantine_date)
    out = invalid.select(
        F.lit(entity).alias("_entity"),
        F.col(REASON).alias(REASON),
        qdate.cast(DateType()).alias("_quarantine_date"),
        F.col("_source_file"),
        F.to_json(F.struct(*[F.col(c) for c in cols])).alias("_payload"),
    )
    return out.withColumn(
        "_quarantine_id",
        F.sha2(F.concat_ws("||", "_entity", REASON, F.coalesce("_source_file", F.lit("")), "_payload"), 256),
    )


def reference_flags(
    df: DataFrame,
    references: Mapping[str, tuple[DataFrame, str]],
    keyless: Column | None = None,
    shown: Mapping[str, Sequence[Column | str]] | None = None,
    written: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Left-join existence flags: ``{flag: (keys_frame, key_column)}``.

    ``shown`` names per flag what else of the matched row of the keys frame goes into the result beside the flag, for a
    caller that would otherwise look it up in a second join on the same key; rows of one key that differ in it all match.

    Key lists are made distinct first so a duplicated key cannot fan out the checked
    rows. The join is on the key and its ``_spread``: for a key a number that follows
    from it, for a NULL, which matches nothing, one that follows from the whole row, or
    ``keyless``: a hash that is needed where a key is NULL only and spares the joins the
    columns that nothing else reads (NULL: the row's place does not matter).
    So rows without a key are dealt to all tasks instead of one. And because the
    distinct keys lie by key alone, Spark deals them out anew for the join; nothing
    but a sort is then between the shuffles and the join, which is what AQE needs to
    split a key that a third of the rows refer to. A small key list is broadcast by
    AQE after its size is measured.

    ``written`` writes a frame by a name and reads it back; it is given for a ``df`` that lies in files, cheap to read again.
    Then a flag that shows nothing of the keys frame is found the other way round: the distinct keys of ``df`` that
    the keys frame has not are written, and where they are at most :data:`BROADCAST_KEYS` by their count, the rows meet
    that list where they are and are not shuffled at all.
    """
    out = df
    for flag, (keys, column) in references.items():
        if written is not None and not (shown or {}).get(flag):
            unknown = df.select(column).filter(F.col(column).isNotNull()).distinct().join(keys.select(column), column, "left_anti")
            unknown = written(unknown, f"unknown-{column}")
            if unknown.count() <= BROADCAST_KEYS:
                met = out.join(F.broadcast(unknown.withColumn(_UNKNOWN, F.lit(True))), column, "left")
                found = F.when(F.col(column).isNotNull() & F.col(_UNKNOWN).isNull(), F.lit(True))
                out = met.select(*out.columns, found.alias(flag))
                continue
        spread = F.octet_length(F.col(column).cast("string"))
        known = keys.select(column, *(shown or {}).get(flag, ())).filter(F.col(column).isNotNull()).distinct()
        flags = known.withColumns({_SPREAD: spread, flag: F.lit(True)})
        dealt = out.withColumn(_SPREAD, F.coalesce(spread, F.hash(*out.columns) if keyless is None else keyless))
        out = dealt.join(flags, on=[column, _SPREAD], how="left").drop(_SPREAD).select(*out.columns, flag, *known.columns[1:])
    return out


def quarantine_counts(quarantined: DataFrame) -> DataFrame:
    """Rows per (entity, reason)."""
    return quarantined.groupBy("_entity", REASON).agg(F.count(F.lit(1)).alias("rows"))
