"""Reference time, trailing periods and calendar buckets.

Every time-dependent operator takes ``as_of`` (default: the time of the query) so that a
result can be recomputed for any moment. Columns may be TIMESTAMP or TIMESTAMP_NTZ; literals
are brought to the column's own type, which keeps the predicate in the Parquet scan.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = str | date | datetime | Column | None


def at(df: DataFrame, column: str, moment: AsOf) -> Column:
    """``moment`` (None = now) in the type of ``df[column]``."""
    if moment is None:
        value = F.current_timestamp()
    elif isinstance(moment, Column):
        value = moment
    else:
        value = F.lit(str(moment))
    return value.cast(df.schema[column].dataType)


def trailing(df: DataFrame, column: str, period: str, as_of: AsOf = None) -> Column:
    """Rows not older than ``period`` (e.g. ``"90 days"``) before ``as_of``."""
    return F.col(column) >= at(df, column, as_of) - F.expr(f"INTERVAL {period}")


def whole_hours_since(df: DataFrame, column: str, period: str, as_of: AsOf = None) -> Column:
    """Start of the hour in which the trailing period begins."""
    return F.date_trunc("hour", at(df, column, as_of) - F.expr(f"INTERVAL {period}")).cast(df.schema[column].dataType)


def on_day(df: DataFrame, column: str, day: str | date) -> Column:
    """Rows of one calendar day, as a half-open range."""
    start = F.to_date(at(df, column, str(day))).cast(df.schema[column].dataType)
    return (F.col(column) >= start) & (F.col(column) < start + F.expr("INTERVAL 1 DAY"))


def in_hour(df: DataFrame, column: str, hour: str | datetime) -> Column:
    """Rows of the hour that contains ``hour``."""
    start = F.date_trunc("hour", at(df, column, str(hour))).cast(df.schema[column].dataType)
    return (F.col(column) >= start) & (F.col(column) < start + F.expr("INTERVAL 1 HOUR"))


def truncated(df: DataFrame, unit: str, column: str) -> Column:
    """``date_trunc`` that keeps the column's type (Spark returns TIMESTAMP for both)."""
    return F.date_trunc(unit, column).cast(df.schema[column].dataType)


def whole_days(later: Column, earlier: Column) -> Column:
    """Full 24-hour periods between two timestamps."""
    return F.extract(F.lit("DAY"), later - earlier)


def moment(as_of: AsOf = None) -> Column:
    """``as_of`` (None = now) as a timestamp."""
    if isinstance(as_of, Column):
        return as_of
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def before(as_of: AsOf, period: str) -> Column:
    """The moment ``period`` before ``as_of``."""
    return moment(as_of) - F.expr(f"INTERVAL {period}")
