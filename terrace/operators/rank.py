"""Dense rank inside a group without sending a whole group to one task.

``dense_rank().over(Window.partitionBy(group).orderBy(v))`` moves every row of a
group into one task; with few groups (product categories) one task may hold a
third of the table. This operator computes the same rank as prefix sums over a
tree of value ranges, and nothing runs before the result is asked for:

1. distinct ``(group, v)`` pairs — a dense rank only depends on distinct values;
2. each value lies in a range of 2^20 units (cents, days, ...), that in one of
   2^40, that in one of 2^60: plain arithmetic, the same in every attempt and task;
3. per range: its distinct values, from the counts of the ranges below it;
4. rank = place of the value in its range + the counts of the ranges before it in
   theirs, one window a level. No window holds more than 2^20 rows, but for the
   topmost: a row per 2^60 units that a group's values span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, IntegralType, TimestampNTZType

_LEVELS = (1 << 20, 1 << 40, 1 << 60)


def _units(value: str, dtype: DataType) -> Column:
    """A whole number that orders as the value does, and is equal where that is."""
    if isinstance(dtype, DecimalType) and dtype.precision + dtype.scale <= 36:
        return (F.col(value) * F.lit(10**dtype.scale).cast(DecimalType(dtype.scale + 1, 0))).cast(DecimalType(38, 0))
    if isinstance(dtype, DateType):
        return F.unix_date(value).cast(DecimalType(38, 0))
    if isinstance(dtype, TimestampNTZType):
        return F.unix_micros(F.col(value).cast("timestamp")).cast(DecimalType(38, 0))
    if isinstance(dtype, IntegralType):
        return F.col(value).cast(DecimalType(38, 0))
    raise TypeError(f"no distributed rank over {dtype.simpleString()}: only over decimals (digits and scale up to 36 together), integers, dates and TIMESTAMP_NTZ")


def dense_rank_within(df: DataFrame, group: str, value: str, rank_col: str, descending: bool = True) -> DataFrame:
    """Add ``rank_col`` = dense rank of ``value`` inside ``group`` (NULL values rank last; NULL is a group of its own)."""
    down = (lambda c: F.col(c).desc_nulls_last()) if descending else (lambda c: F.col(c).asc_nulls_last())
    # Every column is read (and no row has a NULL hash), so that both sides of the last join need the same shuffles of
    # what lies below and Spark runs these once.
    # The hash modulo 2 is never negative: rows stay, but where a caller drops columns of the result, both sides read them all.
    df = df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(2)) >= 0)
    units = df.select(F.col(group).alias("_g"), _units(value, df.schema[value].dataType).alias("_v0"), F.xxhash64(*df.columns).alias("_row"))
    values = units.groupBy("_g", "_v0").agg(F.bit_xor("_row").alias("_rows")).filter("_rows IS NOT NULL")
    ranges = [F.col("_v0") - F.pmod(F.col("_v0"), F.lit(size).cast(DecimalType(20, 0))) for size in _LEVELS]
    values = values.select("_g", "_v0", *[r.cast(DecimalType(38, 0)).alias(f"_v{i + 1}") for i, r in enumerate(ranges)])
    top = len(_LEVELS)
    counts = {1: values.groupBy("_g", *[f"_v{i}" for i in range(1, top + 1)]).agg(F.count(F.lit(1)).alias("_n"))}
    for level in range(2, top + 1):
        counts[level] = counts[level - 1].groupBy("_g", *[f"_v{i}" for i in range(level, top + 1)]).agg(F.sum("_n").alias("_n"))
    before = None  # distinct values in front of each range of the level above, over all levels above
    for level in range(top, -1, -1):
        inside = Window.partitionBy("_g", *([f"_v{level + 1}"] if level < top else [])).orderBy(down(f"_v{level}"))
        if level:
            ahead = F.coalesce(F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            here = counts[level].withColumn("_ahead", ahead).drop("_n")
        else:
            here = values.withColumn("_ahead", F.row_number().over(inside))
        if before is not None:
            on = here["_g"].eqNullSafe(before["_bg"]) & here[f"_v{level + 1}"].eqNullSafe(before["_bv"])
            here = here.join(before, on).withColumn("_ahead", F.col("_ahead") + F.col("_before"))
        before = here.select(F.col("_g").alias("_bg"), F.col(f"_v{level}").alias("_bv"), F.col("_ahead").cast("long").alias("_before"))
    keyed = df.withColumn("_value_units", _units(value, df.schema[value].dataType))
    ranked = keyed.join(before, F.col(group).eqNullSafe(F.col("_bg")) & F.col("_value_units").eqNullSafe(F.col("_bv")))
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], F.col("_before").cast("int").alias(rank_col))


def dense_rank_window(df: DataFrame, group: str, value: str, rank_col: str, descending: bool = True) -> DataFrame:
    """The plain window form, for small inputs and as the test oracle."""
    order_v = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    return df.withColumn(rank_col, F.dense_rank().over(Window.partitionBy(group).orderBy(order_v)))
