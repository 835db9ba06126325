"""The scheduled jobs over the flat tables: segments, daily and hourly reports, deliveries,
forecast."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.grouping import always_one_row, profile
from souk.functions.money import TOTAL, mean, ratio
from souk.functions.times import AsOf, at, in_hour, on_day, whole_days

TS = "timestamp"

# fixed values: segment limits in the order they are tested
CHAMPION = {"orders": 5, "spent": 100000}
LOYAL = {"orders": 3, "spent": 50000}
PROMISING = {"orders": 2, "days": 1}
NEW = {"orders": 1, "days": 1}
AT_RISK_AFTER_DAYS = 2
# fixed values: delivery speed, forecast growth and window, report length
FAST_DAYS = 2
SLOW_DAYS = 6
GROWTH = "1.05"
WINDOW_DAYS = 7
REPORT_ROWS = 7
NONE_LABEL = "N/A"


def customer_segments(
    orders: DataFrame,
    as_of: AsOf = None,
    *,
    champion: dict = CHAMPION,
    loyal: dict = LOYAL,
    promising: dict = PROMISING,
    new: dict = NEW,
    at_risk_after: int = AT_RISK_AFTER_DAYS,
) -> DataFrame:
    """Order count, spend, recency and segment per customer."""
    now = at(orders, TS, as_of)
    n, spent, days = F.col("total_orders"), F.col("total_spent"), F.col("days_since_last_order")
    segment = (
        F.when((n >= champion["orders"]) & (spent >= champion["spent"]), "Champion")
        .when((n >= loyal["orders"]) & (spent >= loyal["spent"]), "Loyal")
        .when((n >= promising["orders"]) & (days <= promising["days"]), "Promising")
        .when((n == new["orders"]) & (days <= new["days"]), "New")
        .when(days > at_risk_after, "At Risk")
        .otherwise("Regular")
    )
    return (
        orders.groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("total_amount").alias("total_spent"),
            mean("total_amount").alias("avg_order_value"),
            F.max(TS).alias("last_order_date"),
        )
        .withColumn("days_since_last_order", whole_days(now, F.col("last_order_date")))
        .withColumn("segment", segment)
    )


def segment_summary(segments: DataFrame) -> DataFrame:
    """Customers, average spend and revenue per segment, highest revenue first."""
    return (
        segments.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            mean("total_spent", TOTAL).alias("avg_spent"),
            F.sum("total_spent").cast(TOTAL).alias("total_revenue"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "segment")
    )


def segmented_customers(segments: DataFrame) -> DataFrame:
    """Number of customers that have a segment row."""
    return segments.agg(F.count(F.lit(1)).alias("total_customers"))


def daily_sales_summary(
    orders: DataFrame, payments: DataFrame, day: str | date | None = None
) -> DataFrame:
    """Sales and payment figures per day: the given day, or every day in one pass."""
    if day is not None:
        orders = orders.filter(on_day(orders, TS, day))
        payments = payments.filter(on_day(payments, TS, day))
    keys = ["summary_date"]
    report = _sales_report(
        orders.withColumn("summary_date", F.to_date(TS)),
        payments.withColumn("summary_date", F.to_date(TS)),
        keys,
    )
    if day is None:
        report = _defaults(report)
    else:
        report = _defaults(always_one_row(report, {"summary_date": F.lit(str(day)).cast("date")}))
    return report.select(
        "summary_date",
        "total_orders",
        "total_revenue",
        F.coalesce(ratio(F.col("total_revenue"), F.col("total_orders"), "decimal(12,2)"), F.lit(0))
        .cast("decimal(12,2)")
        .alias("avg_order_value"),
        "top_product",
        "top_city",
        "successful_payments",
        "failed_payments",
    )


def hourly_stats(orders: DataFrame, payments: DataFrame, hour: str | None = None) -> DataFrame:
    """Sales and payment figures per (date, hour): the hour that contains ``hour``, or all."""
    if hour is not None:
        orders = orders.filter(in_hour(orders, TS, hour))
        payments = payments.filter(in_hour(payments, TS, hour))
    keys = {"stat_date": F.to_date(TS), "stat_hour": F.hour(TS)}
    report = _sales_report(orders.withColumns(keys), payments.withColumns(keys), list(keys))
    if hour is None:
        report = _defaults(report)
    else:
        start = F.lit(str(hour)).cast("timestamp_ntz")
        period = {"stat_date": F.to_date(start), "stat_hour": F.hour(start)}
        report = _defaults(always_one_row(report, period))
    return report.select(
        *keys,
        "total_orders",
        "total_revenue",
        "successful_payments",
        "failed_payments",
        "top_product",
        "top_city",
    )


def _sales_report(orders: DataFrame, payments: DataFrame, keys: list[str]) -> DataFrame:
    sales = profile(
        orders,
        keys,
        rows="total_orders",
        totals={"total_revenue": ("sum", F.col("total_amount"))},
        top={"top_product": "product_name", "top_city": "city"},
        top_counts_null=True,
    )
    paid = payments.groupBy(*keys).agg(
        F.count_if(F.col("status") == "success").alias("successful_payments"),
        F.count_if(F.col("status") == "failed").alias("failed_payments"),
    )
    # both sides hold one row per period here
    return sales.join(paid, keys, "full_outer")


def _defaults(report: DataFrame) -> DataFrame:
    # a period without orders has no top values; with orders, a NULL name may have won
    absent = F.col("total_orders").isNull()
    labels = {
        c: F.when(absent, F.lit(NONE_LABEL)).otherwise(F.col(c)) for c in ("top_product", "top_city")
    }
    zeros = {
        c: F.coalesce(F.col(c), F.lit(0)).cast(t)
        for c, t in {
            "total_orders": "long",
            "total_revenue": TOTAL,
            "successful_payments": "long",
            "failed_payments": "long",
        }.items()
    }
    return report.withColumns({**labels, **zeros})


def delivery_analysis(deliveries: DataFrame, day: str | date | None = None) -> DataFrame:
    """Deliveries per day and city by state and speed, busiest city first."""
    counts = delivery_counts(deliveries, day)
    return counts.orderBy("analysis_date", F.desc("total_deliveries"), F.asc_nulls_last("city"))


def delivery_counts(deliveries: DataFrame, day: str | date | None = None) -> DataFrame:
    """The figures of :func:`delivery_analysis` in no order, for tables and further aggregates."""
    if day is not None:
        deliveries = deliveries.filter(on_day(deliveries, TS, day))
    status, days = F.col("status"), F.col("estimated_days")
    return (
        deliveries.groupBy(F.to_date(TS).alias("analysis_date"), "city")
        .agg(
            F.count(F.lit(1)).alias("total_deliveries"),
            F.count_if(status == "dispatched").alias("dispatched_count"),
            F.count_if(status == "in_transit").alias("in_transit_count"),
            F.count_if(status == "out_for_delivery").alias("out_for_delivery_count"),
            mean("estimated_days").alias("avg_estimated_days"),
            F.count_if(days <= FAST_DAYS).alias("fast_deliveries"),
            F.count_if(days >= SLOW_DAYS).alias("slow_deliveries"),
        )
    )


def delivery_insights(analysis: DataFrame, day: str | date | None = None) -> DataFrame:
    """Fastest and slowest city, totals and the plain mean of the city averages per day.

    Cities without an average rank last among the fastest and first among the slowest, as NULLs
    do when the averages are sorted.
    """
    if day is not None:
        analysis = analysis.filter(F.col("analysis_date") == F.lit(str(day)).cast("date"))
    avg, city = F.col("avg_estimated_days"), F.col("city")
    unknown = avg.isNull()
    best = F.struct(city.alias("city"), avg.alias("avg"))
    return (
        analysis.groupBy("analysis_date")
        .agg(
            F.min_by(best, F.struct(unknown, avg, city)).alias("fast"),
            F.min_by(best, F.struct(~unknown, -avg, city)).alias("slow"),
            F.sum("total_deliveries").alias("total_deliveries"),
            F.sum("fast_deliveries").alias("fast_deliveries"),
            F.sum("slow_deliveries").alias("slow_deliveries"),
            mean("avg_estimated_days").alias("overall_avg_days"),
        )
        .select(
            "analysis_date",
            F.col("fast.city").alias("fastest_city"),
            F.col("fast.avg").alias("fastest_avg_days"),
            F.col("slow.city").alias("slowest_city"),
            F.col("slow.avg").alias("slowest_avg_days"),
            "total_deliveries",
            "fast_deliveries",
            "slow_deliveries",
            "overall_avg_days",
        )
    )


def revenue_forecast(
    orders: DataFrame, day: str | date | None = None, window_days: int = WINDOW_DAYS, by: Sequence[str] = ()
) -> DataFrame:
    """Forecast from the mean daily revenue of the days before: the given day (which may have no
    orders yet), or every day with orders.

    Days without orders do not count towards the mean. Accuracy is 0 where nothing was sold. ``by``
    (city, category) makes a forecast for each of its values instead of one for all.
    """
    if day is not None:
        start = at(orders, TS, str(day))
        orders = orders.filter(
            (F.col(TS) >= start - F.expr(f"INTERVAL {window_days} DAYS"))
            & (F.col(TS) < start + F.expr("INTERVAL 1 DAY"))
        )
    daily = orders.groupBy(*by, F.to_date(TS).alias("forecast_date")).agg(
        F.sum("total_amount").alias("revenue")
    )
    if day is None:
        # one row per day; a range frame over days, not over orders
        before = Window.partitionBy(*by).orderBy(F.unix_date("forecast_date")).rangeBetween(-window_days, -1)
        stats = daily.select(
            *by,
            "forecast_date",
            F.col("revenue").alias("actual"),
            F.sum("revenue").over(before).alias("total"),
            F.count("revenue").over(before).alias("days"),
            F.stddev_samp("revenue").over(before).alias("std"),
        )
    else:
        target = F.lit(str(day)).cast("date")
        earlier = F.when(F.col("forecast_date") < target, F.col("revenue"))
        stats = daily.groupBy(*by).agg(
            target.alias("forecast_date"),
            F.sum(F.when(F.col("forecast_date") == target, F.col("revenue"))).alias("actual"),
            F.sum(earlier).alias("total"),
            F.count(earlier).alias("days"),
            F.stddev_samp(earlier).alias("std"),
        )
    zero = F.lit(0).cast(TOTAL)
    total = F.coalesce("total", zero).cast(TOTAL)
    actual = F.coalesce("actual", zero).cast(TOTAL)
    days = F.greatest(F.col("days"), F.lit(1)).cast("decimal(5,0)")
    predicted = total * F.lit(GROWTH).cast("decimal(3,2)")
    # |predicted - actual| / actual in percent, from the unrounded prediction
    error = F.try_divide(
        F.abs(predicted - actual * days) * F.lit(100), (actual * days).cast("decimal(27,2)")
    )
    return stats.select(
        *by,
        "forecast_date",
        (predicted / days).cast("decimal(24,2)").alias("predicted_revenue"),
        (total / days).cast(TOTAL).alias("avg_last_7_days"),
        F.coalesce("std", F.lit(0.0)).alias("std_revenue"),
        actual.alias("actual_revenue"),
        F.when(actual > 0, F.lit(100) - error.cast("decimal(24,2)"))
        .otherwise(F.lit(0))
        .cast("decimal(24,2)")
        .alias("accuracy_pct"),
    )


def forecast_report(forecast: DataFrame, k: int = REPORT_ROWS) -> DataFrame:
    """The last ``k`` forecasts with their distance from the actual revenue."""
    predicted, actual = F.col("predicted_revenue"), F.col("actual_revenue")
    return (
        forecast.select(
            "forecast_date",
            F.round(predicted, 2).alias("predicted"),
            F.round(actual, 2).alias("actual"),
            F.round(F.abs(predicted - actual), 2).alias("difference"),
        )
        .orderBy(F.desc("forecast_date"))
        .limit(k)
    )
