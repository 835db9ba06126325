"""Exact decimal arithmetic. Rounding is half away from zero throughout.

Sums of ``decimal(12,2)`` come back as ``decimal(22,2)`` and are kept that wide: at large
volumes a day's revenue does not fit the 14 digits of the classic table layout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(12,2)"
TOTAL = "decimal(22,2)"
RATE = "decimal(5,2)"


def amount(column: str | Column) -> Column:
    return _col(column).cast(AMOUNT)


def ratio(numerator: Column, denominator: Column, dtype: str) -> Column:
    """``numerator / denominator`` rounded once, NULL where the denominator is 0."""
    return F.try_divide(numerator.cast("decimal(22,2)"), denominator.cast("decimal(20,0)")).cast(dtype)


def mean(column: str | Column, dtype: str = AMOUNT) -> Column:
    """Average rounded once from sum and count; ``avg`` would round at 6 digits first."""
    return ratio(F.sum(_col(column)), F.count(_col(column)), dtype)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` with 2 decimals, NULL on an empty whole."""
    return F.try_divide(part.cast("decimal(20,0)") * F.lit(100), whole.cast("decimal(20,0)")).cast(RATE)


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
