"""The two quality suites: per-table checks with a log, and the daily report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from souk.functions.times import AsOf, moment
from souk.operators import quality
from souk.sinks.writers import append
from souk.sources.schemas import (
    DATA_QUALITY_LOG,
    DQ_RUN_LOG,
    FLAT_ORDERS,
    FLAT_PAYMENTS,
    ORDERS,
    PAYMENTS,
    RAW_EVENTS,
)
from souk.sources.tables import read_table


def run_layer_checks(
    spark: SparkSession, root: str, as_of: AsOf = None, raise_failures: bool = True
) -> DataFrame:
    """Raw table first, then orders and payments; every result is logged before a failure is
    raised. Returns the summary of the last hours."""
    suites = (
        (quality.bronze_checks, RAW_EVENTS, True),
        (quality.silver_order_checks, ORDERS, True),
        (quality.payment_failure_check, PAYMENTS, False),
    )
    for check, table, strict in suites:
        log = check(read_table(spark, table, root), as_of).persist()
        append(quality.stamped(log, as_of), DQ_RUN_LOG, root)
        if strict and raise_failures:
            quality.raise_on_failure(log)
        log.unpersist()
    return quality.dq_summary(read_table(spark, DQ_RUN_LOG, root), as_of)


def report_day(spark: SparkSession, root: str, day: str, raise_failures: bool = True) -> DataFrame:
    """Log one day's report; a failed day is logged as well, then raised."""
    report = quality.daily_quality_report(
        read_table(spark, FLAT_ORDERS, root, since=moment(day), until=moment(day)),
        read_table(spark, FLAT_PAYMENTS, root),  # an order may be paid on another day
        day,
    ).persist()
    try:
        append(report, DATA_QUALITY_LOG, root)
        if raise_failures and report.filter("status = 'FAILED'").count():
            raise quality.QualityFailure(f"quality report of {day} failed")
    finally:
        report.unpersist()
    return report
