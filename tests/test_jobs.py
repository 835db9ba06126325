"""The scheduled jobs end to end on written tables."""

import pytest
from pyspark.sql import functions as F

from souk.operators import quality
from souk.plans import daily_jobs, gold_refresh, quality_runs
from souk.sinks.writers import append, insert_ignore
from souk.sources import bindings as b
from souk.sources import schemas as s
from souk.sources.tables import create_all, read_table
from souk.streaming import event_tables

SF_DIR = "/root/testdata/sf0.001"
NOW = "2024-01-31"


def rows(df, *drop):
    return sorted(map(str, df.drop(*drop).collect()))


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('silver')}"
    create_all(spark, root)
    event_tables.write_batch(b.messages(b.table(spark, SF_DIR, "events")), root)
    return root


@pytest.fixture(scope="module")
def flat(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('flat')}"
    create_all(spark, root)
    orders = b.event_orders(
        spark, SF_DIR, "order_id", "customer_id", "product_name", "product_category", "city", "status",
        "quantity", "price", "total_amount", "timestamp",
    ).withColumnRenamed("product_category", "category")
    insert_ignore(orders, s.FLAT_ORDERS, root)
    insert_ignore(b.payments(spark, SF_DIR, "payment_id", "order_id", "amount", "method", "status", "timestamp"), s.FLAT_PAYMENTS, root)
    moved = b.deliveries(spark, SF_DIR, "delivery_id", "order_id", "line_no", "city", "status", "estimated_days", "timestamp")
    insert_ignore(moved, s.FLAT_DELIVERIES, root, ["timestamp"])
    return root


GOLD = (s.HOURLY_REVENUE, s.DAILY_REVENUE, s.REVENUE_BY_CITY, s.PAYMENT_FAILURES, s.DELAYED_SHIPMENTS, s.CUSTOMER_METRICS)


def test_gold_refresh_is_repeatable(spark, silver):
    gold_refresh.refresh_gold(spark, silver, NOW)
    first = {t.name: rows(read_table(spark, t, silver), "refreshed_at") for t in GOLD}
    assert all(first.values())
    gold_refresh.refresh_gold(spark, silver, NOW, since="2024-01-20")
    assert {t.name: rows(read_table(spark, t, silver), "refreshed_at") for t in GOLD} == first
    daily = read_table(spark, s.DAILY_REVENUE, silver).agg(F.sum("total_revenue"), F.sum("order_count")).first()
    orders = read_table(spark, s.ORDERS, silver).agg(F.sum("total_amount"), F.count("*")).first()
    assert tuple(daily) == tuple(orders)
    assert gold_refresh.churn_risk_customers(spark, silver).first()[0] == 0


def test_time_partitions_are_pruned(spark, silver):
    some = read_table(spark, s.ORDERS, silver, since=F.lit("2024-01-20").cast("timestamp"))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {str(r[0]) for r in some.select("event_date").distinct().collect()} <= {f"2024-01-{d}" for d in range(20, 32)}


def test_daily_jobs(spark, flat):
    summary = daily_jobs.segment_customers(spark, flat, NOW)
    assert sum(r.customers for r in summary.collect()) == read_table(spark, s.CUSTOMER_SEGMENTS, flat).count()
    for day in ("2024-01-10", "2024-01-10", None):
        daily_jobs.summarize_day(spark, flat, day)
    days = read_table(spark, s.DAILY_SUMMARY, flat)
    assert days.count() == days.select("summary_date").distinct().count() == 30
    daily_jobs.summarize_hour(spark, flat, "2024-01-10 05:00:00")
    once = rows(read_table(spark, s.HOURLY_STATS, flat), "created_at")
    daily_jobs.summarize_hour(spark, flat, "2024-01-10 05:00:00")
    assert rows(read_table(spark, s.HOURLY_STATS, flat), "created_at") == once and len(once) == 1
    daily_jobs.summarize_hour(spark, flat)
    assert rows(read_table(spark, s.HOURLY_STATS, flat).filter("stat_date = '2024-01-10' and stat_hour = 5"), "created_at") == once


def test_deliveries_and_forecast_keep_the_first(spark, flat):
    insights = daily_jobs.analyze_deliveries(spark, flat)
    assert insights.count() == read_table(spark, s.DELIVERY_ANALYSIS, flat).select("analysis_date").distinct().count()
    assert daily_jobs.forecast_revenue(spark, flat, "2024-01-31").count() == 1
    late = spark.createDataFrame([("late", "77", "2024-01-31")], "order_id STRING, total_amount STRING, timestamp STRING")
    append(late, s.FLAT_ORDERS, flat)
    kept = daily_jobs.forecast_revenue(spark, flat, "2024-01-31").first()
    assert kept.actual == 0
    assert daily_jobs.forecast_revenue(spark, flat, "2024-01-31", refresh=True).first().actual == 77


def test_quality_runs(spark, silver, flat):
    summary = quality_runs.run_layer_checks(spark, silver, "2024-01-31", raise_failures=False)
    log = read_table(spark, s.DQ_RUN_LOG, silver)
    assert log.count() == 10 and sum(r.check_count for r in summary.collect()) == 10
    with pytest.raises(quality.QualityFailure):
        quality_runs.report_day(spark, flat, "2024-01-10")
    assert read_table(spark, s.DATA_QUALITY_LOG, flat).first().status == "FAILED"
