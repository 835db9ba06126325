"""KPI tables computed from the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.filters import not_cancelled
from souk.functions.grouping import profile
from souk.functions.money import mean, percent, ratio
from souk.functions.times import AsOf, at, trailing, truncated, whole_hours_since

# fixed values
REFRESH_PERIOD = "48 hours"
CHURN_RISK_AFTER_DAYS = 30


def _in_period(rows: DataFrame, as_of: AsOf, period: str | None, whole_hours: bool) -> DataFrame:
    if not period:
        return rows
    if whole_hours:
        return rows.filter(F.col("event_time") >= whole_hours_since(rows, "event_time", period, as_of))
    return rows.filter(trailing(rows, "event_time", period, as_of))


def hourly_revenue(
    orders: DataFrame, as_of: AsOf = None, period: str | None = REFRESH_PERIOD, whole_hours: bool = False
) -> DataFrame:
    """Revenue per hour and category over the trailing period (None = all history).

    ``whole_hours`` starts at a full hour, as a result that replaces stored hours must.
    """
    live = _in_period(not_cancelled(orders), as_of, period, whole_hours)
    return live.groupBy(
        truncated(live, "hour", "event_time").alias("hour_bucket"), "product_category"
    ).agg(
        F.sum("total_amount").alias("total_revenue"),
        F.count(F.lit(1)).alias("order_count"),
        mean("total_amount").alias("avg_order_value"),
    )


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Revenue, orders, customers, average and most frequent category per day."""
    live = not_cancelled(orders).select(
        F.to_date("event_time").alias("date_bucket"), "user_id", "product_category", "total_amount"
    )
    days = profile(
        live,
        ["date_bucket"],
        rows="order_count",
        totals={
            "total_revenue": ("sum", F.col("total_amount")),
            "_priced": ("sum", F.col("total_amount").isNotNull().cast("long")),
        },
        top={"top_category": "product_category"},
        distinct={"unique_customers": "user_id"},
    )
    return days.select(
        "date_bucket",
        "total_revenue",
        "order_count",
        "unique_customers",
        ratio(F.col("total_revenue"), F.col("_priced"), "decimal(12,2)").alias("avg_order_value"),
        "top_category",
    )


def revenue_by_city(orders: DataFrame) -> DataFrame:
    """Revenue per day and city."""
    return (
        not_cancelled(orders)
        .groupBy(F.to_date("event_time").alias("date_bucket"), "city")
        .agg(F.sum("total_amount").alias("total_revenue"), F.count(F.lit(1)).alias("order_count"))
    )


def payment_failure_metrics(
    payments: DataFrame, as_of: AsOf = None, period: str | None = REFRESH_PERIOD, whole_hours: bool = False
) -> DataFrame:
    """Attempts, failures and failure rate per hour and payment method; periods as in
    :func:`hourly_revenue`."""
    payments = _in_period(payments, as_of, period, whole_hours)
    attempts, failed = F.count(F.lit(1)), F.count_if(F.col("payment_status") == "failed")
    return payments.groupBy(
        truncated(payments, "hour", "event_time").alias("hour_bucket"), "payment_method"
    ).agg(
        attempts.alias("total_attempts"),
        failed.alias("failed_count"),
        percent(failed, attempts).alias("failure_rate"),
    )


def delayed_shipments(deliveries: DataFrame) -> DataFrame:
    """Late deliveries per day and city; one without an actual duration is not late."""
    shipped = F.count(F.lit(1))
    late = F.count_if(F.col("actual_days") > F.col("estimated_days"))
    return deliveries.groupBy(F.to_date("event_time").alias("date_bucket"), "city").agg(
        late.alias("delayed_count"),
        shipped.alias("total_shipments"),
        percent(late, shipped).alias("delay_rate"),
    )


def customer_metrics(
    orders: DataFrame, as_of: AsOf = None, churn_after: int = CHURN_RISK_AFTER_DAYS
) -> DataFrame:
    """Lifetime figures per customer, with favourite category and payment method."""
    live = not_cancelled(orders).select(
        "user_id", "product_category", "payment_method", "total_amount", "event_time"
    )
    people = profile(
        live,
        ["user_id"],
        rows="total_orders",
        totals={
            "total_spend": ("sum", F.col("total_amount")),
            "_priced": ("sum", F.col("total_amount").isNotNull().cast("long")),
            "first_order_date": ("min", F.to_date("event_time")),
            "last_order_date": ("max", F.to_date("event_time")),
        },
        top={"favourite_category": "product_category", "favourite_payment": "payment_method"},
    )
    days = F.datediff(at(orders, "event_time", as_of).cast("date"), F.col("last_order_date"))
    return people.select(
        "user_id",
        "total_orders",
        "total_spend",
        ratio(F.col("total_spend"), F.col("_priced"), "decimal(12,2)").alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        days.alias("days_since_last_order"),
        "favourite_category",
        "favourite_payment",
        (days > churn_after).alias("churn_risk_flag"),
    )


def churn_risk_count(metrics: DataFrame) -> DataFrame:
    """Number of customers flagged in ``customer_metrics``."""
    return metrics.agg(F.count_if("churn_risk_flag").alias("churn_risk_customers"))
