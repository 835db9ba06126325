"""The nightly KPI refresh: silver tables into gold tables.

The tables are independent of each other except that customer metrics come last. Each refresh is
one Catalyst plan whose result replaces the range it covers as one version of the table, so readers see
all of a refresh or nothing, a repeated run changes nothing but the refresh time, and a group that no
longer exists goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.times import AsOf, before, moment
from souk.operators import gold
from souk.operators.medallion import CANCELLED, apply_cancellations, cancellations, current_deliveries
from souk.sinks.versioned import replace_version
from souk.sources.events import parse_events
from souk.sources.schemas import (
    CUSTOMER_METRICS,
    DAILY_REVENUE,
    DELAYED_SHIPMENTS,
    DELIVERIES,
    HOURLY_REVENUE,
    ORDERS,
    PAYMENT_FAILURES,
    PAYMENTS,
    RAW_EVENTS,
    REVENUE_BY_CITY,
)
from souk.sources.tables import create_if_absent, read_table


def stored_cancellations(spark: SparkSession, root: str) -> DataFrame:
    """Orders that a cancellation event in the raw table names."""
    create_if_absent(spark, RAW_EVENTS, root)
    raw = read_table(spark, RAW_EVENTS, root).where(F.col("event_type") == CANCELLED)
    return cancellations(parse_events(raw.select(F.col("raw_payload").alias("value"), F.col("kafka_topic").alias("topic"))))


def refresh_gold(
    spark: SparkSession,
    root: str,
    as_of: AsOf = None,
    since: str | None = None,
    cancelled: DataFrame | None = None,
) -> None:
    """Refresh all KPI tables.

    ``since`` limits the per-day order tables to days from that date on; the trailing tables start at
    the full hour in which their period begins; deliveries and customer metrics cover all history.
    Only the day partitions needed are read. ``cancelled`` (``order_id``) takes orders out; by default
    those that a cancellation event in the raw table names.
    """
    if cancelled is None:
        cancelled = stored_cancellations(spark, root)
    first_day = None if since is None else F.to_date(moment(since))
    recent = F.date_trunc("hour", before(as_of, gold.REFRESH_PERIOD))

    def orders(start: Column | None = None) -> DataFrame:
        rows = read_table(spark, ORDERS, root, since=start)
        if start is not None:
            rows = rows.filter(F.col("event_time") >= start.cast("timestamp"))
        return apply_cancellations(rows, cancelled)

    # a delivery counts once, in the state of its latest event, so a changed day cannot be
    # recomputed from that day's events alone
    deliveries = current_deliveries(read_table(spark, DELIVERIES, root))
    recent_payments = read_table(spark, PAYMENTS, root, since=recent)
    replace_version(gold.hourly_revenue(orders(recent), as_of, whole_hours=True), HOURLY_REVENUE, root, recent)
    replace_version(gold.daily_revenue(orders(first_day)), DAILY_REVENUE, root, first_day)
    replace_version(gold.revenue_by_city(orders(first_day)), REVENUE_BY_CITY, root, first_day)
    replace_version(
        gold.payment_failure_metrics(recent_payments, as_of, whole_hours=True), PAYMENT_FAILURES, root, recent
    )
    replace_version(gold.delayed_shipments(deliveries), DELAYED_SHIPMENTS, root)
    replace_version(gold.customer_metrics(orders(), as_of), CUSTOMER_METRICS, root)


def churn_risk_customers(spark: SparkSession, root: str) -> DataFrame:
    return gold.churn_risk_count(read_table(spark, CUSTOMER_METRICS, root))
