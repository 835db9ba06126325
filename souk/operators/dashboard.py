"""The dashboard's analytical queries over the flat orders table.

Columns used: order_id, customer_id, customer_name, product_name, category, quantity,
total_amount, city, status, timestamp. All take the common filter arguments of
``dashboard_filter`` through ``**filters``. Order of rows is the reports' own; ties are broken by
name so that results do not depend on task order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.filters import dashboard_filter
from souk.functions.money import TOTAL, mean, ratio
from souk.functions.times import AsOf, at, trailing, truncated, whole_days

TS = "timestamp"

# fixed values: report lengths, risk and churn limits
LOOKBACK = "90 days"
LOOKBACK_DAYS = 90
TOP_PRODUCTS = 10
TOP_INVENTORY = 15
TOP_CHURNED = 10
FORECAST_DAYS = 7
MIN_HISTORY = 3
VELOCITY_LEVELS = (("critical", "2"), ("high", "1"), ("medium", "0.5"))
LOWEST_LEVEL = "low"
TREND_BORDER_PCT = 5
CHURNED_AFTER_DAYS = 30
AT_RISK_AFTER_DAYS = 10
NEVER_ORDERED_DAYS = 999
HIGH_VALUE_SPEND = 50000


def summary(orders: DataFrame, **filters) -> DataFrame:
    """One row of headline figures; zeros when nothing matches."""
    return dashboard_filter(orders, **filters).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum("total_amount"), F.lit(0)).cast(TOTAL).alias("total_revenue"),
        F.count_distinct("customer_id").alias("total_customers"),
        F.coalesce(mean("total_amount"), F.lit(0)).cast("decimal(12,2)").alias("average_order_value"),
    )


def revenue_by_city(orders: DataFrame, k: int | None = None, **filters) -> DataFrame:
    """Revenue per city, highest first; ``k`` keeps the top cities only."""
    return _ranked_sum(orders, "city", "revenue", k, filters)


def category_sales(orders: DataFrame, k: int | None = None, **filters) -> DataFrame:
    """Revenue per category, highest first."""
    return _ranked_sum(orders, "category", "sales", k, filters)


def _ranked_sum(orders, by, out, k, filters) -> DataFrame:
    ranked = (
        dashboard_filter(orders, **filters)
        .groupBy(by)
        .agg(F.sum("total_amount").alias(out))
        .orderBy(F.desc_nulls_first(out), F.asc_nulls_last(by))
    )
    return ranked.limit(k) if k else ranked


def order_status(orders: DataFrame, **filters) -> DataFrame:
    """Orders per status."""
    return dashboard_filter(orders, **filters).groupBy("status").count()


def monthly_revenue(orders: DataFrame, **filters) -> DataFrame:
    """Revenue per calendar month (``yyyy-MM``)."""
    return (
        dashboard_filter(orders, **filters)
        .groupBy(F.date_format(TS, "yyyy-MM").alias("month"))
        .agg(F.sum("total_amount").alias("revenue"))
        .orderBy(F.asc_nulls_last("month"))
    )


def top_products(orders: DataFrame, k: int = TOP_PRODUCTS, **filters) -> DataFrame:
    """The ``k`` products with the highest revenue."""
    return (
        dashboard_filter(orders, **filters)
        .groupBy("product_name")
        .agg(
            F.sum("quantity").alias("total_quantity"),
            F.sum("total_amount").alias("total_revenue"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("product_name"))
        .limit(k)
    )


def top_products_share(orders: DataFrame, k: int = TOP_PRODUCTS, **filters) -> DataFrame:
    """The top products with their rank and their revenue as whole percent of the first."""
    best = top_products(orders, k, **filters)
    rank = Window.orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("product_name"))
    # the window sees the k report rows only
    lead = F.max("total_revenue").over(Window.partitionBy())
    return best.select(
        F.row_number().over(rank).alias("rank"),
        "*",
        F.round(F.try_divide(F.col("total_revenue") * 100, lead), 0).cast("int").alias("share_pct"),
    )


def filter_options(orders: DataFrame) -> DataFrame:
    """The values offered by the city and category filters."""
    options = orders.select(
        F.inline(
            F.array(
                F.struct(F.lit("city").alias("kind"), F.col("city").alias("value")),
                F.struct(F.lit("category").alias("kind"), F.col("category").alias("value")),
            )
        )
    )
    return options.distinct()


# --- trailing 90 days -----------------------------------------------------------------


def _recent(orders: DataFrame, as_of: AsOf, period: str, filters: dict) -> DataFrame:
    return dashboard_filter(orders.filter(trailing(orders, TS, period, as_of)), **filters)


def _revenue_by_day(orders: DataFrame, as_of: AsOf, period: str, filters: dict) -> DataFrame:
    return (
        _recent(orders, as_of, period, filters)
        .groupBy(F.to_date(TS).alias("day"))
        .agg(F.sum("total_amount").alias("revenue"))
    )


def daily_revenue_series(
    orders: DataFrame, as_of: AsOf = None, period: str = LOOKBACK, **filters
) -> DataFrame:
    """Revenue per day that has orders; gaps are not filled."""
    return _revenue_by_day(orders, as_of, period, filters).orderBy("day")


def sales_prediction(
    orders: DataFrame,
    as_of: AsOf = None,
    period: str = LOOKBACK,
    days: int = FORECAST_DAYS,
    **filters,
) -> DataFrame:
    """Predicted revenue of the ``days`` after the last day with orders.

    The trend per day is the difference between the mean of the later and of the earlier half of
    the series, divided by the length of the earlier half. No rows on fewer than three days.
    """
    return _predicted(orders, as_of, period, days, filters).orderBy("day")


def _predicted(orders: DataFrame, as_of: AsOf, period: str, days: int, filters: dict) -> DataFrame:
    series = _revenue_by_day(orders, as_of, period, filters)
    # the window runs over one row per day of the period
    placed = series.select(
        "day",
        "revenue",
        F.row_number().over(Window.orderBy("day")).alias("position"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n"),
    ).withColumn("half", F.expr("n div 2"))
    early = F.col("position") <= F.col("half")
    trend = placed.groupBy("n", "half").agg(
        F.sum(F.when(early, F.col("revenue"))).alias("early"),
        F.sum(F.when(~early, F.col("revenue"))).alias("late"),
        F.max("day").alias("last_day"),
        F.max_by("revenue", "day").alias("last_revenue"),
    )
    wide = "decimal(38,12)"
    slope = F.expr(
        f"cast((cast(late as {wide}) / (n - half) - cast(early as {wide}) / half) as {wide}) / half"
    )
    steps = trend.filter(F.col("n") >= MIN_HISTORY).select(
        "last_day",
        "last_revenue",
        slope.cast("decimal(32,10)").alias("slope"),
        F.explode(F.sequence(F.lit(1), F.lit(days))).alias("i"),
    )
    value = F.col("last_revenue") + F.col("slope") * F.col("i")
    return steps.select(
        F.date_add("last_day", F.col("i")).alias("day"),
        F.greatest(F.lit(0), value).cast(TOTAL).alias("predicted"),
    )


def forecast_series(orders: DataFrame, as_of: AsOf = None, **filters) -> DataFrame:
    """Actual and predicted revenue as one series, the missing side NULL."""
    actual = _revenue_by_day(orders, as_of, LOOKBACK, filters)
    predicted = _predicted(orders, as_of, LOOKBACK, FORECAST_DAYS, filters)
    return actual.unionByName(predicted, allowMissingColumns=True).orderBy("day")


def _revenue_by_week(orders: DataFrame, as_of: AsOf, period: str, filters: dict) -> DataFrame:
    return (
        _recent(orders, as_of, period, filters)
        .groupBy("category", truncated(orders, "week", TS).alias("week"))
        .agg(F.sum("total_amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )


def weekly_category_revenue(
    orders: DataFrame, as_of: AsOf = None, period: str = LOOKBACK, **filters
) -> DataFrame:
    """Revenue and orders per category and week (weeks start on Monday)."""
    weekly = _revenue_by_week(orders, as_of, period, filters)
    return weekly.orderBy(F.asc_nulls_last("category"), "week")


def category_forecast(
    orders: DataFrame, as_of: AsOf = None, k: int | None = None, **filters
) -> DataFrame:
    """Growth from the first to the last week per category, with the weeks as a nested list;
    ``k`` keeps the categories that grow most."""
    weekly = _revenue_by_week(orders, as_of, LOOKBACK, filters)
    week = F.struct(
        F.to_date("week").alias("week"), F.col("revenue"), F.col("orders")
    )
    per_category = weekly.groupBy("category").agg(
        F.count(F.lit(1)).alias("weeks"),
        F.min_by("revenue", "week").alias("first"),
        F.max_by("revenue", "week").alias("last"),
        F.sum("revenue").cast(TOTAL).alias("total_revenue"),
        # one entry per week of the period
        F.sort_array(F.collect_list(week)).alias("weekly_data"),
    )
    change = (F.col("last") - F.col("first")) * 100
    growth = F.when(F.col("first") > 0, change / F.col("first")).otherwise(F.lit(0))
    border = F.col("first") * TREND_BORDER_PCT
    trend = (
        F.when((F.col("first") > 0) & (change > border), "rising")
        .when((F.col("first") > 0) & (change < -border), "falling")
        .otherwise("stable")
    )
    ranked = (
        per_category.filter(F.col("weeks") >= 2)
        .select(
            "category",
            "total_revenue",
            growth.cast("decimal(20,1)").alias("growth_pct"),
            trend.alias("trend"),
            "weekly_data",
        )
        .orderBy(F.desc("growth_pct"), F.asc_nulls_last("category"))
    )
    return ranked.limit(k) if k else ranked


def inventory_alert(
    orders: DataFrame,
    as_of: AsOf = None,
    *,
    k: int = TOP_INVENTORY,
    lookback_days: int = LOOKBACK_DAYS,
    levels: tuple[tuple[str, str], ...] = VELOCITY_LEVELS,
    **filters,
) -> DataFrame:
    """The best-selling products with orders per day and a risk level.

    The level is taken from the rounded velocity, which counts orders, not units.
    """
    best = (
        _recent(orders, as_of, f"{lookback_days} days", filters)
        .groupBy("product_name", "category")
        .agg(
            F.sum("quantity").alias("total_sold"),
            F.count(F.lit(1)).alias("order_count"),
            F.count("quantity").alias("_known"),
            F.max(TS).alias("_last"),
            F.sum("total_amount").alias("total_revenue"),
        )
        .orderBy(
            F.desc_nulls_first("total_sold"),
            F.asc_nulls_last("product_name"),
            F.asc_nulls_last("category"),
        )
        .limit(k)
    )
    velocity = ratio(F.col("order_count"), F.lit(lookback_days), "decimal(20,2)")
    return best.select(
        "product_name",
        "category",
        F.coalesce("total_sold", F.lit(0)).cast("long").alias("total_sold"),
        "order_count",
        F.coalesce(ratio(F.col("total_sold"), F.col("_known"), "decimal(12,1)"), F.lit(0))
        .cast("decimal(12,1)")
        .alias("avg_qty_per_order"),
        F.to_date("_last").alias("last_ordered"),
        F.coalesce("total_revenue", F.lit(0)).cast(TOTAL).alias("total_revenue"),
        velocity.alias("velocity_per_day"),
        _level(velocity, levels).alias("risk_level"),
    )


def _level(value: Column, levels) -> Column:
    first, *others = levels
    choice = F.when(value > F.lit(first[1]).cast("decimal(20,2)"), first[0])
    for name, border in others:
        choice = choice.when(value > F.lit(border).cast("decimal(20,2)"), name)
    return choice.otherwise(LOWEST_LEVEL)


# --- churn ------------------------------------------------------------------------------


def customer_activity(
    orders: DataFrame,
    as_of: AsOf = None,
    *,
    churned_after: int = CHURNED_AFTER_DAYS,
    at_risk_after: int = AT_RISK_AFTER_DAYS,
    **filters,
) -> DataFrame:
    """Per customer (id and name): orders, last order, spend, days since, activity state."""
    now = at(orders, TS, as_of)
    days = F.coalesce(whole_days(now, F.col("last_order")), F.lit(NEVER_ORDERED_DAYS))
    state = (
        F.when(F.col("days_since_last") > churned_after, "churned")
        .when(F.col("days_since_last") > at_risk_after, "at_risk")
        .otherwise("active")
    )
    return (
        dashboard_filter(orders, **filters)
        .groupBy("customer_id", "customer_name")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.max(TS).alias("last_order"),
            F.coalesce(F.sum("total_amount"), F.lit(0)).cast(TOTAL).alias("total_spent"),
        )
        .withColumn("days_since_last", days)
        .withColumn("state", state)
    )


def churn_summary(orders: DataFrame, as_of: AsOf = None, **options) -> DataFrame:
    """Number of active, at-risk and churned customers."""
    states = customer_activity(orders, as_of, **options)
    return states.agg(
        *[F.count_if(F.col("state") == s).alias(s) for s in ("active", "at_risk", "churned")],
        F.count(F.lit(1)).alias("total"),
    )


def churn_high_value(
    orders: DataFrame,
    as_of: AsOf = None,
    *,
    min_spend: int = HIGH_VALUE_SPEND,
    k: int = TOP_CHURNED,
    **options,
) -> DataFrame:
    """The churned customers who spent most."""
    return (
        customer_activity(orders, as_of, **options)
        .filter((F.col("state") == "churned") & (F.col("total_spent") > min_spend))
        .select(
            "customer_id",
            "customer_name",
            "total_orders",
            "days_since_last",
            "total_spent",
            F.lit("high").alias("risk"),
        )
        .orderBy(F.desc("total_spent"), F.asc_nulls_last("customer_id"), F.asc_nulls_last("customer_name"))
        .limit(k)
    )


def reports(orders: DataFrame, as_of: AsOf = None, **filters) -> dict[str, DataFrame]:
    """All figures of one dashboard refresh. They share the filtered orders: cache
    ``dashboard_filter(orders, ...)`` and pass that if they are to be read only once."""
    plain = (
        summary, revenue_by_city, category_sales, order_status, monthly_revenue, top_products,
    )
    timed = (sales_prediction, category_forecast, inventory_alert, churn_summary, churn_high_value)
    return {
        **{f.__name__: f(orders, **filters) for f in plain},
        **{f.__name__: f(orders, as_of, **filters) for f in timed},
    }
