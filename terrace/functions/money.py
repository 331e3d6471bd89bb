"""Money arithmetic on decimals.

Prices are ``DECIMAL(16,4)``, rates ``DECIMAL(8,6)`` and computed amounts
``DECIMAL(18,2)``. An integer quantity times a price times a rate has at most 38
digits, so products are exact; only amounts are rounded (HALF_UP, to cents), and
results do not depend on binary floating point. A source value with more digits
than these hold is not rounded: it is unreadable (``normalize.typed``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

PRICE = DecimalType(16, 4)
RATE = DecimalType(8, 6)
AMOUNT = DecimalType(18, 2)

# Fixed value-band thresholds (lifetime value, inclusive lower bounds).
HIGH_VALUE_FLOOR = 1000
MEDIUM_VALUE_FLOOR = 300


def _c(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def amount(expr: Column) -> Column:
    """Round to cents and store as ``AMOUNT``; NULL where that has too few digits, so one row cannot stop a job."""
    return F.round(expr, 2).try_cast(AMOUNT)


def gross(quantity: str | Column, unit_price: str | Column) -> Column:
    return amount(_c(quantity) * _c(unit_price))


def net(quantity: str | Column, unit_price: str | Column, discount: str | Column) -> Column:
    """Net from the *unrounded* gross: ``round(q * p * (1 - d), 2)``."""
    return amount(_c(quantity) * _c(unit_price) * (F.lit(1) - _c(discount)))


def cents(column: str | Column) -> Column:
    """Exact integer cents of a money column."""
    return (_c(column) * F.lit(100)).cast("long")


def rounded_average(column: str | Column) -> Column:
    """Average of a money column rounded half away from zero to cents.

    Computed from the exact integer sum of cents, ``(2|s| + n) div 2n``, so the
    result never suffers the double rounding of ``round(avg(x), 2)``. NULL when
    the group has no non-NULL value.
    """
    s = F.sum(cents(column))
    n = F.count(_c(column))
    num = F.abs(s) * 2 + n
    den = n * 2
    # Exact integer division: num - (num mod den) is a multiple of den.
    magnitude = ((num - num % den).cast("decimal(38,0)") / den.cast("decimal(38,0)")).cast("long")
    signed = F.when(s < 0, -magnitude).otherwise(magnitude)
    return F.when(n > 0, (signed.cast("decimal(20,0)") / F.lit(100)).cast(AMOUNT))


def round_sum(column: str | Column) -> Column:
    return F.round(F.sum(_c(column)), 2)


def value_band(value: str | Column) -> Column:
    """HIGH from 1000, MEDIUM from 300, else LOW (NULL value is LOW)."""
    v = _c(value)
    return (
        F.when(v >= HIGH_VALUE_FLOOR, F.lit("HIGH"))
        .when(v >= MEDIUM_VALUE_FLOOR, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )
