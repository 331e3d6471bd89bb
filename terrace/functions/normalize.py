"""Normalisation and safe parsing expressions.

Spark 4 runs ANSI mode by default, where ``to_date('nope')`` raises. Source
text is therefore parsed with the ``try_`` forms: a bad value becomes NULL and
is handled by the validation rules instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DecimalType, StringType, StructType, TimestampNTZType, TimestampType

# Fixed pattern for a syntactically plausible e-mail address.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def _c(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def key(column: str | Column) -> Column:
    """Business key: trimmed (spaces only) and upper-cased."""
    return F.upper(F.trim(_c(column)))


def title(column: str | Column) -> Column:
    return F.initcap(F.trim(_c(column)))


def lower_trim(column: str | Column) -> Column:
    return F.lower(F.trim(_c(column)))


def parse_date(df: DataFrame, column: str) -> Column:
    """Text → DATE (NULL when unparseable); typed input passes through."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, DateType):
        return F.col(column)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(F.col(column))
    return F.try_to_date(F.col(column).cast(StringType()))


def utc(instant: Column) -> Column:
    """TIMESTAMP → TIMESTAMP_NTZ holding its UTC wall clock, whatever the session's zone (and its hours that come twice)."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    return ntz_literal("1970-01-01 00:00:00") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def parse_timestamp(df: DataFrame, column: str) -> Column:
    """Text → TIMESTAMP_NTZ holding the UTC wall clock, whatever the session's zone.

    A text that names its offset or zone is that instant; one that names none is read as UTC. NULL when
    unparseable. Typed input is converted, never re-parsed.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, TimestampNTZType):
        return F.col(column)
    if isinstance(dtype, TimestampType):
        return utc(F.col(column))
    if isinstance(dtype, DateType):
        return F.col(column).cast(TimestampNTZType())
    text = F.col(column).cast(StringType())
    # behind the hour only an offset or a zone has a sign or a letter
    return F.when(text.rlike(":.*[A-Za-z+-]"), utc(F.try_to_timestamp(text))).otherwise(text.try_cast(TimestampNTZType()))


# Digits behind the point up to which numbers are compared before they get their type.
_SCALE = 18
UNREADABLE = "_unreadable"


def exact(text: Column, target: DataType) -> Column:
    """Text → ``target`` where that loses nothing, else NULL: no digit is rounded away, ``2.5`` is no integer."""
    text = F.trim(text)
    if isinstance(target, BooleanType):
        return F.when(F.lower(text).isin("true", "false"), F.lower(text) == "true")
    number = text.try_cast(DecimalType(38, _SCALE))
    value = number.try_cast(target)
    return F.when((value == number) & ~text.rlike(rf"\.[0-9]{{{_SCALE}}}[0-9]*[1-9]"), value)


def typed(df: DataFrame, contract: StructType) -> DataFrame:
    """Text columns of ``df`` that the contract types otherwise, parsed by :func:`exact`; typed columns pass through.

    ``_unreadable`` names the columns that hold a text which is not exactly a value of their type (comma-joined, in
    contract order; NULL if none); their values are NULL. Blank text is a missing value.
    """
    parsed = {
        f.name: exact(F.col(f.name), f.dataType)
        for f in contract.fields
        if f.name in df.columns and isinstance(df.schema[f.name].dataType, StringType) and not isinstance(f.dataType, StringType)
    }
    bad = [F.when((F.trim(F.col(c)) != "") & v.isNull(), F.lit(c)) for c, v in parsed.items()]
    names = F.concat_ws(",", *bad) if bad else F.lit("")
    return df.withColumns({**parsed, UNREADABLE: F.when(names != "", names)})


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so no time zone is involved.

    ``F.lit(datetime)`` makes a zone-aware TIMESTAMP in the Python process's
    local zone; casting that to NTZ then applies the session zone, which shifts
    the value whenever the two zones differ.
    """
    import datetime as _dt

    if isinstance(value, Column):
        return value.cast(TimestampNTZType())
    if isinstance(value, _dt.datetime):
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast(TimestampNTZType())
    if isinstance(value, _dt.date):
        return F.lit(value.isoformat()).cast(TimestampNTZType())
    return F.lit(value).cast(TimestampNTZType())


def email_ok(column: str | Column) -> Column:
    """Pattern test; NULL in, NULL out (three-valued, made total by the rules)."""
    return _c(column).rlike(EMAIL_PATTERN)
