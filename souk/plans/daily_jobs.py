"""The scheduled jobs over the flat tables, each writing its own report table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from souk.functions.times import AsOf, before, moment
from souk.operators import jobs
from souk.sinks.writers import insert_ignore, replace_range, upsert
from souk.sources.schemas import (
    CUSTOMER_SEGMENTS,
    DAILY_SUMMARY,
    DELIVERY_ANALYSIS,
    FLAT_DELIVERIES,
    FLAT_ORDERS,
    FLAT_PAYMENTS,
    HOURLY_STATS,
    REVENUE_FORECAST,
    Table,
)
from souk.sources.tables import read_table


def _days(spark: SparkSession, table: Table, root: str, day: str | None, back: int = 0) -> DataFrame:
    """The partitions of a day and of ``back`` days before it; without a day the whole table."""
    if day is None:
        return read_table(spark, table, root)
    return read_table(spark, table, root, since=before(day, f"{back} days"), until=moment(day))


def segment_customers(spark: SparkSession, root: str, as_of: AsOf = None) -> DataFrame:
    """Refresh the segments and return their summary."""
    replace_range(jobs.customer_segments(read_table(spark, FLAT_ORDERS, root), as_of), CUSTOMER_SEGMENTS, root)
    return jobs.segment_summary(read_table(spark, CUSTOMER_SEGMENTS, root))


def summarize_day(spark: SparkSession, root: str, day: str | None = None) -> None:
    """The sales summary of a day (None: of all days); running it again replaces the row."""
    report = jobs.daily_sales_summary(
        _days(spark, FLAT_ORDERS, root, day), _days(spark, FLAT_PAYMENTS, root, day), day
    )
    upsert(report, DAILY_SUMMARY, root)


def summarize_hour(spark: SparkSession, root: str, hour: str | None = None) -> None:
    """The statistics of an hour (None: of all hours); running it again replaces the row."""
    report = jobs.hourly_stats(
        _days(spark, FLAT_ORDERS, root, hour), _days(spark, FLAT_PAYMENTS, root, hour), hour
    )
    upsert(report, HOURLY_STATS, root)


def analyze_deliveries(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """Keep the first analysis of each day and city; returns the day's insights."""
    report = jobs.delivery_counts(_days(spark, FLAT_DELIVERIES, root, day), day)
    insert_ignore(report, DELIVERY_ANALYSIS, root)
    return jobs.delivery_insights(_days(spark, DELIVERY_ANALYSIS, root, day), day)


def forecast_revenue(
    spark: SparkSession, root: str, day: str | None = None, refresh: bool = False
) -> DataFrame:
    """Store the forecast and return the report. The first forecast of a day stays unless
    ``refresh`` is set, which also brings its actual revenue up to date."""
    forecast = jobs.revenue_forecast(_days(spark, FLAT_ORDERS, root, day, jobs.WINDOW_DAYS), day)
    (upsert if refresh else insert_ignore)(forecast, REVENUE_FORECAST, root)
    return jobs.forecast_report(read_table(spark, REVENUE_FORECAST, root))
