"""Borders, empty input and reference moments of the operators."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from souk.functions.filters import dashboard_filter, date_preset, name_contains
from souk.functions.grouping import profile
from souk.operators import dashboard, gold, jobs, links, medallion, quality

FLAT = (
    "order_id STRING, customer_id STRING, customer_name STRING, product_name STRING, category STRING, "
    "quantity INT, price STRING, total_amount STRING, city STRING, status STRING, ts STRING"
)


def flat(spark, rows=()):
    """rows: (order_id, customer, product, category, quantity, amount, city, status, ts)"""
    full = [(o, c, f"n-{c}", p, k, q, a, a, city, s, t) for o, c, p, k, q, a, city, s, t in rows]
    df = spark.createDataFrame(full, FLAT)
    return df.select(
        *[F.col(c).cast("decimal(12,2)").alias(c) if c in ("price", "total_amount") else c for c in df.columns if c != "ts"],
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def spends(spark, rows):
    """rows: (customer, amount, ts)"""
    return flat(spark, [(str(i), c, "p", "k", 1, a, "x", "placed", t) for i, (c, a, t) in enumerate(rows)])


def payments(spark, rows=()):
    df = spark.createDataFrame(list(rows), "payment_id STRING, order_id STRING, status STRING, ts STRING")
    return df.select("payment_id", "order_id", "status", F.col("ts").cast("timestamp").alias("timestamp"))


def silver(orders):
    return orders.select(
        "order_id", F.col("customer_id").alias("user_id"), F.col("category").alias("product_category"),
        F.col("status").alias("payment_method"), "city", F.col("status").alias("order_status"), "quantity",
        "total_amount", F.col("timestamp").alias("event_time"), F.col("timestamp").alias("processed_at"),
    )


def test_empty_input(spark):
    orders, paid = flat(spark), payments(spark)
    row = dashboard.summary(orders).first()
    assert tuple(row) == (0, Decimal("0.00"), 0, Decimal("0.00"))
    for f in (dashboard.revenue_by_city, dashboard.category_sales, dashboard.order_status, dashboard.monthly_revenue,
              dashboard.top_products, dashboard.top_products_share, dashboard.sales_prediction,
              dashboard.category_forecast, dashboard.inventory_alert, dashboard.churn_high_value, dashboard.forecast_series):
        assert f(orders).count() == 0
    assert tuple(dashboard.churn_summary(orders).first()) == (0, 0, 0, 0)
    for f in (gold.hourly_revenue, gold.daily_revenue, gold.revenue_by_city, gold.customer_metrics):
        assert f(silver(orders)).count() == 0
    assert gold.churn_risk_count(gold.customer_metrics(silver(orders))).first()[0] == 0
    assert jobs.customer_segments(orders).count() == 0
    assert jobs.daily_sales_summary(orders, paid).count() == 0
    day = jobs.daily_sales_summary(orders, paid, "2024-01-01").first()
    assert (day.total_orders, day.top_product, day.top_city, day.successful_payments) == (0, "N/A", "N/A", 0)
    assert day.avg_order_value == 0
    hour = jobs.hourly_stats(orders, paid, "2024-01-01 05:00:00").first()
    assert (hour.stat_date, hour.stat_hour, hour.total_orders) == (date(2024, 1, 1), 5, 0)
    forecast = jobs.revenue_forecast(orders, "2024-01-08").first()
    assert (forecast.predicted_revenue, forecast.actual_revenue, forecast.accuracy_pct, forecast.std_revenue) == (0, 0, 0, 0.0)
    report = quality.daily_quality_report(orders, paid, "2024-01-01").first()
    assert (report.payment_fail_rate, report.status) == (0, "PASSED")
    assert [r.status for r in quality.silver_order_checks(silver(orders)).collect()] == ["passed"] * 5


def test_filters(spark):
    orders = spends(spark, [("a", "1", "2024-01-01"), ("a", "2", "2024-01-02"), ("a", "4", "2024-01-02 10:00")])

    def total(**f):
        return int(dashboard.summary(orders, **f).first().total_revenue)

    assert total(date_from="2024-01-02") == 6
    assert total(date_to="2024-01-02") == 3  # midnight only
    assert total(date_to="2024-01-02", inclusive_end=True) == 7
    assert total(city="", category=None) == 7
    assert total(city="elsewhere") == 0
    assert dashboard_filter(orders) is orders
    assert name_contains(orders.withColumn("n", F.lit("Air MAX")), "n", "max").count() == 3


def test_presets():
    assert date_preset("Last 30d", as_of=date(2024, 3, 1)) == {"date_from": "2024-01-31", "date_to": "2024-03-01"}
    assert date_preset(None) == {"date_from": None, "date_to": None}
    assert date_preset("Custom", custom=("a", "b")) == {"date_from": "a", "date_to": "b"}
    with pytest.raises(ValueError):
        date_preset("Custom", custom=("2024-01-01", None))


def test_churn_borders(spark):
    orders = spends(spark, [
        ("ten", "1", "2024-01-21"), ("eleven", "1", "2024-01-20"), ("thirty", "1", "2024-01-01"),
        ("thirty1", "60000", "2023-12-31"), ("now", "1", "2024-01-31"), ("limit", "50000", "2023-01-01"),
    ])
    unknown = orders.withColumn("timestamp", F.when(F.col("customer_id") == "now", F.col("timestamp")).otherwise(F.col("timestamp")))
    row = dashboard.churn_summary(unknown, "2024-01-31").first()
    assert (row.active, row.at_risk, row.churned, row.total) == (2, 2, 2, 6)
    assert [r.customer_id for r in dashboard.churn_high_value(orders, "2024-01-31").collect()] == ["thirty1"]
    never = spends(spark, [("x", "1", None)])
    assert dashboard.customer_activity(never, "2024-01-31").first().days_since_last == 999


def test_segment_borders(spark):
    rows = [("champion", "20000", "2023-01-01")] * 5 + [("loyal", "12500", "2023-01-01")] * 4
    rows += [("poor", "1", "2023-01-01")] * 5 + [("promising", "1", "2024-01-30")] * 2
    rows += [("new", "1", "2024-01-30"), ("regular", "1", "2024-01-29"), ("risk", "1", "2024-01-28")]
    got = {r.customer_id: r.segment for r in jobs.customer_segments(spends(spark, rows), "2024-01-31").collect()}
    assert got == {
        "champion": "Champion", "loyal": "Loyal", "poor": "At Risk", "promising": "Promising",
        "new": "New", "regular": "Regular", "risk": "At Risk",
    }


def test_velocity_levels(spark):
    rows = []
    for name, n in {"two": 180, "over2": 181, "one": 90, "half": 45, "overhalf": 46}.items():
        rows += [(f"{name}{i}", "c", name, "k", 1, "1", "x", "placed", "2024-01-30") for i in range(n)]
    got = {r.product_name: r.risk_level for r in dashboard.inventory_alert(flat(spark, rows), "2024-01-31").collect()}
    assert got == {"two": "high", "over2": "critical", "one": "medium", "half": "low", "overhalf": "medium"}


@pytest.mark.parametrize("last, growth, trend", [("105", "5.0", "stable"), ("105.01", "5.0", "rising"), ("95", "-5.0", "stable"), ("94.99", "-5.0", "falling")])
def test_growth_borders(spark, last, growth, trend):
    orders = spends(spark, [("c", "100", "2024-01-01"), ("c", last, "2024-01-15")])
    row = dashboard.category_forecast(orders, "2024-01-31").first()
    assert (str(row.growth_pct), row.trend) == (growth, trend)
    assert [(str(w.week), w.orders) for w in row.weekly_data] == [("2024-01-01", 1), ("2024-01-15", 1)]


def test_prediction_formula(spark):
    revenue = [100, 130, 90, 160, 120]
    orders = spends(spark, [("c", str(v), f"2024-01-{10 + 2 * i}") for i, v in enumerate(revenue)])
    trend = (sum(revenue[2:]) / 3 - sum(revenue[:2]) / 2) / 2
    got = dashboard.sales_prediction(orders, "2024-01-31").collect()
    assert [r.day for r in got] == [date(2024, 1, 19 + i) for i in range(7)]
    assert [float(r.predicted) for r in got] == pytest.approx([max(0, 120 + trend * i) for i in range(1, 8)], abs=0.005)
    falling = spends(spark, [("c", v, f"2024-01-1{i}") for i, v in enumerate(("900", "500", "10"))])
    assert {float(r.predicted) for r in dashboard.sales_prediction(falling, "2024-01-31").collect()} == {0.0}
    assert dashboard.sales_prediction(spends(spark, [("c", "1", "2024-01-01"), ("c", "1", "2024-01-02")]), "2024-01-31").count() == 0


def test_forecast_one_day_equals_all_days(spark):
    orders = spends(spark, [("c", str(10 * i + 1), f"2024-01-{i:02d} 08:00") for i in (1, 2, 4, 5, 7, 9, 10, 16)])
    every = {r.forecast_date: tuple(r) for r in jobs.revenue_forecast(orders).collect()}
    for day, row in every.items():
        assert tuple(jobs.revenue_forecast(orders, str(day)).first()) == pytest.approx(row)


def test_daily_and_hourly_one_period_equals_all(spark):
    orders = flat(spark, [
        ("1", "c", "lamp", "k", 1, "5", "Pune", "placed", "2024-01-01 10:00"),
        ("2", "c", "cup", "k", 1, "7", "Agra", "placed", "2024-01-01 10:30"),
        ("3", "c", None, "k", 1, "7", "Agra", "placed", "2024-01-02 11:00"),
    ])
    paid = payments(spark, [("p1", "1", "success", "2024-01-01 10:05"), ("p2", "2", "failed", "2024-01-03 10:05")])
    days = {str(r.summary_date): tuple(r) for r in jobs.daily_sales_summary(orders, paid).collect()}
    assert set(days) == {"2024-01-01", "2024-01-02", "2024-01-03"}
    for day, row in days.items():
        assert tuple(jobs.daily_sales_summary(orders, paid, day).first()) == row
    assert days["2024-01-01"][4:6] == ("cup", "Agra")  # tie: lowest name
    assert days["2024-01-02"][4] is None  # the NULL name was the most frequent
    assert days["2024-01-03"][4:] == ("N/A", "N/A", 0, 1)
    hours = {(str(r.stat_date), r.stat_hour): tuple(r) for r in jobs.hourly_stats(orders, paid).collect()}
    assert set(hours) == {("2024-01-01", 10), ("2024-01-02", 11), ("2024-01-03", 10)}
    for (day, hour), row in hours.items():
        assert tuple(jobs.hourly_stats(orders, paid, f"{day} {hour}:20:00").first()) == row


def test_profile_against_plain_aggregates(spark):
    df = spark.range(3000).select(
        (F.col("id") % 3 * F.col("id") % 7).alias("k"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 11).cast("string")).alias("a"),
        (F.col("id") % 13).alias("b"),
        F.col("id").alias("v"),
    )
    got = profile(df, ["k"], rows="n", totals={"s": ("sum", F.col("v")), "lo": ("min", F.col("v"))}, top={"t": "a"}, distinct={"d": "b"})
    expected = df.groupBy("k").agg(
        F.count("*"), F.sum("v"), F.min("v"), F.expr("mode() WITHIN GROUP (ORDER BY a)"), F.count_distinct("b")
    )
    assert sorted(map(tuple, got.select("k", "n", "s", "lo", "t", "d").collect())) == sorted(map(tuple, expected.collect()))


def test_delayed_counts_unknown_duration_as_in_time(spark):
    rows = spark.createDataFrame([("x", 1, 2), ("x", 3, None), ("x", 3, 3)], "city STRING, estimated_days INT, actual_days INT")
    got = gold.delayed_shipments(rows.withColumn("event_time", F.lit("2024-01-01").cast("timestamp"))).first()
    assert (got.delayed_count, got.total_shipments, str(got.delay_rate)) == (1, 3, "33.33")


def test_delivery_insights_rank_missing_averages_as_sorted_nulls(spark):
    rows = spark.createDataFrame([("a", 3, "s"), ("b", None, "s"), ("c", 5, "s")], "city STRING, estimated_days INT, status STRING")
    analysis = jobs.delivery_analysis(rows.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")))
    got = jobs.delivery_insights(analysis, "2024-01-01").first()
    assert (got.fastest_city, got.slowest_city, got.slowest_avg_days) == ("a", "b", None)


def test_checks_grade_and_raise(spark):
    rows = [(str(i), "c", "p", "k", 1, "1", "x", "placed", "2024-01-31") for i in range(99)]
    rows += [("0", "c", "p", "k", -1, "1", "x", "placed", "2024-01-31")]
    log = quality.silver_order_checks(silver(flat(spark, rows)), "2024-01-31", "r")
    got = {r.check_name: (r.status, r.records_checked, r.records_failed) for r in log.collect()}
    assert got["valid_quantity"] == ("warning", 100, 1)
    assert got["no_duplicate_order_ids"] == ("warning", 99, 1)
    assert got["no_null_user_id"] == ("passed", 100, 0)
    quality.raise_on_failure(log)
    generic = quality.run_checks(spark.range(10), "silver", "numbers", [("few", F.count("*"), F.count_if(F.col("id") < 5))])
    with pytest.raises(quality.QualityFailure):
        quality.raise_on_failure(generic)


def test_daily_report_flags(spark):
    orders = flat(spark, [
        ("1", "c", "p", "k", 1, "5", "x", "placed", "2024-01-01"), ("1", "c", "p", "k", 1, "5", "x", "placed", "2024-01-01"),
        ("2", None, "p", "k", 1, "5", "x", "placed", "2024-01-02"), ("3", "c", "p", "k", 0, "5", "x", "placed", "2024-01-03"),
        ("4", "c", "p", "k", 1, "5", "x", "placed", "2024-01-04"), ("5", "c", "p", "k", 1, "5", "x", "placed", "2024-01-05"),
    ])
    paid = payments(spark, [("p", "1", "success", "2024-01-01"), ("q", "4", "failed", "2024-01-04"), (None, "5", "success", "2024-01-05")])
    got = {str(r.check_date): tuple(r)[1:] for r in quality.daily_quality_report(orders, paid).collect()}
    assert got["2024-01-01"] == (0, 0, 1, 0, Decimal("0.00"), "FAILED")
    assert got["2024-01-02"] == (1, 0, 0, 1, Decimal("0.00"), "FAILED")
    assert got["2024-01-03"] == (0, 1, 0, 1, Decimal("0.00"), "FAILED")
    assert got["2024-01-04"] == (0, 0, 0, 0, Decimal("100.00"), "FAILED")
    assert got["2024-01-05"] == (0, 0, 0, 1, Decimal("0.00"), "PASSED")
    for day, row in got.items():
        assert tuple(quality.daily_quality_report(orders, paid, day).first())[1:] == row


def test_cancellations_and_orphans(spark):
    orders = spark.createDataFrame([("a", "placed"), ("b", "placed")], "order_id STRING, order_status STRING")
    cancelled = spark.createDataFrame([("a",), ("a",), ("z",)], "order_id STRING")
    assert sorted(map(tuple, medallion.apply_cancellations(orders, cancelled).collect())) == [("a", "cancelled"), ("b", "placed")]
    assert [r.order_id for r in links.orphans(cancelled, orders, "order_id").collect()] == ["z"]


def test_dashboard_reports(spark):
    orders = spends(spark, [("c", "5", "2024-01-01"), ("c", "7", "2024-01-09"), ("d", "7", "2024-01-17")])
    all_reports = dashboard.reports(orders, "2024-01-31", city="x")
    assert len(all_reports) == 11
    counts = {name: df.count() for name, df in all_reports.items()}
    assert counts["sales_prediction"] == 7 and counts["category_forecast"] == 1 and counts["summary"] == 1
    assert dashboard.category_forecast(orders, "2024-01-31", k=1).count() == 1


def test_orders_without_payment_one_day(spark):
    orders = spends(spark, [("c", "5", "2024-01-01"), ("c", "7", "2024-01-02"), ("d", "7", "2024-01-02")])
    paid = payments(spark, [("p", "1", "failed", "2024-02-01"), ("q", "1", "success", "2024-02-01"), (None, "2", "x", "2024-01-02")])
    assert [r.order_id for r in links.orders_without_payment(orders, paid, "2024-01-02").collect()] == ["2"]
    assert sorted(r.order_id for r in links.orders_without_payment(orders, paid).collect()) == ["0", "2"]
