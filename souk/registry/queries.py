"""One entry per operator: ``name -> (spark, sf_dir) -> DataFrame``.

Every query runs over whole tables. Results are brought to plain types (``portable``) so that they
compare with another engine's.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.filters import date_preset, name_contains
from souk.functions.grouping import first_per_key
from souk.functions.times import before
from souk.operators import dashboard, gold, jobs, links, medallion, quality, validate
from souk.registry import reference_time as now
from souk.session import run_dir
from souk.plans import cube, incremental
from souk.plans.gold_refresh import refresh_gold
from souk.sinks.writers import append, encode_events, insert_ignore, replace_range, upsert
from souk.sources import bindings as b
from souk.sources.catalogue import with_seed
from souk.sources.events import parse_events
from souk.sources.positions import ConsumerGroup
from souk.sources.schemas import (
    CUSTOMER_METRICS,
    CUSTOMER_SEGMENTS,
    DAILY_REVENUE,
    DATA_QUALITY_LOG,
    DELAYED_SHIPMENTS,
    DELIVERIES,
    DELIVERIES_TOPIC,
    DQ_RUN_LOG,
    FLAT_ORDERS,
    FLAT_PAYMENTS,
    FLAT_TABLES,
    HOURLY_REVENUE,
    ORDERS,
    ORDERS_TOPIC,
    PAYMENT_FAILURES,
    PAYMENTS,
    PAYMENTS_TOPIC,
    RAW_EVENTS,
    REJECTED,
    REVENUE_BY_CITY,
    TOPIC_THROUGHPUT,
    Table,
    key_bucket,
)
from souk.sources.tables import conform, create_all, read_table
from souk.streaming import checked, event_tables, flat_tables, unpaid, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# order lines with a key that repeats in the data; the bucket follows from the key
LINES = Table(
    "public.order_lines",
    "order_id LONG, line_no INT, product_id LONG, quantity INT, total_amount DECIMAL(12,2)",
    keys=("order_id", "line_no"),
    partition=key_bucket("order_id", "line_no", buckets=16),
    key_fixes_partition=True,
)
LINE_COLUMNS = ("order_id", "line_no", "product_id", "quantity", "total_amount")
RUN = "check"  # run id of the quality checks, fixed so that results compare


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # the tables hold times without a zone; the pipeline reads them as UTC
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return portable(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def portable(df: DataFrame) -> DataFrame:
    """Decimals as double, integers as long, dates and times as text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(c.alias(f.name))
    return df.select(*columns)


# --- dashboard ------------------------------------------------------------------------


@query
def summary(spark, sf):
    return dashboard.summary(b.orders(spark, sf, "customer_id", "total_amount"))


@query
def summary_filtered(spark, sf):
    rows = b.orders(spark, sf, "customer_id", "total_amount", "city", "category", "timestamp")
    return dashboard.summary(
        rows, city="NATION_7", category="2-HIGH", date_from="1996-01-01", date_to="2000-12-31"
    )


@query
def summary_last_30d(spark, sf):
    rows = b.orders(spark, sf, "customer_id", "total_amount", "timestamp")
    preset = date_preset("Last 30d", as_of=date.fromisoformat(now.ORDERS))
    return dashboard.summary(rows, **preset, inclusive_end=True)


@query
def revenue_by_city(spark, sf):
    return dashboard.revenue_by_city(b.orders(spark, sf, "city", "total_amount"))


@query
def top_cities(spark, sf):
    return dashboard.revenue_by_city(b.orders(spark, sf, "city", "total_amount"), k=10)


@query
def category_sales(spark, sf):
    return dashboard.category_sales(b.orders(spark, sf, "category", "total_amount"))


@query
def order_status(spark, sf):
    return dashboard.order_status(b.orders(spark, sf, "status"))


@query
def monthly_revenue(spark, sf):
    return dashboard.monthly_revenue(b.orders(spark, sf, "total_amount", "timestamp"))


@query
def top_products(spark, sf):
    return dashboard.top_products(b.order_lines(spark, sf, "product_name", "quantity", "total_amount"))


@query
def top_products_share(spark, sf):
    rows = b.order_lines(spark, sf, "product_name", "quantity", "total_amount")
    return dashboard.top_products_share(rows)


@query
def product_name_contains(spark, sf):
    rows = b.order_lines(spark, sf, "product_name", "quantity", "total_amount")
    return dashboard.top_products(name_contains(rows, "product_name", "RED"))


@query
def filter_options(spark, sf):
    return dashboard.filter_options(b.orders(spark, sf, "city", "category"))


@query
def daily_revenue_series(spark, sf):
    return dashboard.daily_revenue_series(b.orders(spark, sf, "total_amount", "timestamp"), now.ORDERS)


@query
def sales_prediction(spark, sf):
    return dashboard.sales_prediction(b.event_orders(spark, sf, "total_amount", "timestamp"), now.EVENTS)


@query
def forecast_series(spark, sf):
    return dashboard.forecast_series(b.event_orders(spark, sf, "total_amount", "timestamp"), now.EVENTS)


@query
def weekly_category_revenue(spark, sf):
    rows = b.order_lines(spark, sf, "category", "total_amount", "timestamp")
    return dashboard.weekly_category_revenue(rows, now.ORDERS)


@query
def category_forecast(spark, sf):
    rows = b.order_lines(spark, sf, "category", "total_amount", "timestamp")
    return dashboard.category_forecast(rows, now.ORDERS).drop("weekly_data")


@query
def category_weekly_nested(spark, sf):
    rows = b.order_lines(spark, sf, "category", "total_amount", "timestamp")
    entry = F.transform(
        "weekly_data",
        lambda w: F.concat_ws(
            "/", w["week"].cast("string"), w["revenue"].cast("string"), w["orders"].cast("string")
        ),
    )
    nested = dashboard.category_forecast(rows, now.ORDERS)
    return nested.select("category", F.concat_ws(" ", entry).alias("weeks"))


@query
def inventory_alert(spark, sf):
    rows = b.order_lines(spark, sf, "brand", "quantity", "total_amount", "timestamp")
    rows = rows.withColumnRenamed("brand", "product_name").withColumn("category", F.lit("brand"))
    return dashboard.inventory_alert(rows, now.ORDERS)


@query
def churn_summary(spark, sf):
    rows = b.orders(spark, sf, "customer_id", "customer_name", "total_amount", "timestamp")
    return dashboard.churn_summary(rows, now.ORDERS)


@query
def churn_high_value(spark, sf):
    rows = b.orders(spark, sf, "customer_id", "customer_name", "total_amount", "timestamp")
    return dashboard.churn_high_value(rows, now.ORDERS)


FILTERED = {"city": "NATION_7", "date_from": "2000-01-01"}


@query
def sales_prediction_filtered(spark, sf):
    rows = b.event_orders(spark, sf, "total_amount", "timestamp", "city")
    return dashboard.sales_prediction(rows, now.EVENTS, city="Delhi")


@query
def category_forecast_filtered(spark, sf):
    rows = b.order_lines(spark, sf, "category", "total_amount", "timestamp", "city")
    return dashboard.category_forecast(rows, now.ORDERS, **FILTERED).drop("weekly_data")


@query
def churn_summary_filtered(spark, sf):
    rows = b.orders(spark, sf, "customer_id", "customer_name", "total_amount", "timestamp", "city")
    return dashboard.churn_summary(rows, now.ORDERS, city="NATION_7")


def _in_order(report):
    """A report of few rows with the place of each, so that its order is compared too."""
    placed = report.withColumn("_place", F.monotonically_increasing_id())
    return placed.withColumn("place", F.row_number().over(Window.orderBy("_place"))).drop("_place")


@query
def revenue_by_city_in_order(spark, sf):
    return _in_order(dashboard.revenue_by_city(b.orders(spark, sf, "city", "total_amount")))


@query
def top_products_in_order(spark, sf):
    rows = b.order_lines(spark, sf, "product_name", "quantity", "total_amount")
    return _in_order(dashboard.top_products(rows))


@query
def segment_summary_in_order(spark, sf):
    return _in_order(jobs.segment_summary(_segments(spark, sf)))


# --- gold -------------------------------------------------------------------------------

SILVER_COLUMNS = ("user_id", "product_category", "payment_method", "city", "order_status", "total_amount", "event_time")


@query
def hourly_revenue(spark, sf):
    return gold.hourly_revenue(b.event_orders(spark, sf, *SILVER_COLUMNS), now.EVENTS)


@query
def gold_daily_revenue(spark, sf):
    return gold.daily_revenue(b.event_orders(spark, sf, *SILVER_COLUMNS))


@query
def gold_revenue_by_city(spark, sf):
    return gold.revenue_by_city(b.event_orders(spark, sf, *SILVER_COLUMNS))


@query
def payment_failure_metrics(spark, sf):
    rows = b.payments(spark, sf, "payment_method", "payment_status", "event_time")
    return gold.payment_failure_metrics(rows, now.EVENTS)


@query
def payment_failure_history(spark, sf):
    rows = b.payments(spark, sf, "payment_method", "payment_status", "event_time")
    return gold.payment_failure_metrics(rows, period=None)


@query
def delayed_shipments(spark, sf):
    rows = b.deliveries(spark, sf, "city", "estimated_days", "actual_days", "event_time")
    return gold.delayed_shipments(rows)


@query
def customer_metrics(spark, sf):
    return gold.customer_metrics(b.event_orders(spark, sf, *SILVER_COLUMNS), now.EVENTS)


@query
def churn_risk_count(spark, sf):
    rows = b.orders(spark, sf, "customer_id", "category", "status", "total_amount", "timestamp")
    rows = rows.withColumnsRenamed(
        {
            "customer_id": "user_id",
            "category": "product_category",
            "status": "order_status",
            "timestamp": "event_time",
        }
    ).withColumn("payment_method", F.col("product_category"))
    return gold.churn_risk_count(gold.customer_metrics(rows, now.ORDERS))


# --- scheduled jobs -----------------------------------------------------------------------


@query
def customer_segments(spark, sf):
    return _segments(spark, sf)


@query
def segment_summary(spark, sf):
    return jobs.segment_summary(_segments(spark, sf))


@query
def segmented_customers(spark, sf):
    rows = b.orders(spark, sf, "customer_id", "total_amount", "timestamp")
    return jobs.segmented_customers(jobs.customer_segments(rows, now.ORDERS))


def _segments(spark, sf):
    """All orders, with limits that fit these customers' longer histories: each label occurs."""
    rows = b.orders(spark, sf, "customer_id", "total_amount", "timestamp")
    return jobs.customer_segments(
        rows,
        now.SEGMENTS,
        champion={"orders": 15, "spent": 4_000_000},
        loyal={"orders": 12, "spent": 2_000_000},
        promising={"orders": 8, "days": 60},
        new={"orders": 6, "days": 400},
        at_risk_after=120,
    )


@query
def daily_sales_summary(spark, sf):
    return jobs.daily_sales_summary(
        b.event_orders(spark, sf, "product_name", "city", "total_amount", "timestamp"),
        b.payments(spark, sf, "status", "timestamp"),
    )


@query
def daily_sales_one_day(spark, sf):
    return jobs.daily_sales_summary(
        b.event_orders(spark, sf, "product_name", "city", "total_amount", "timestamp"),
        b.payments(spark, sf, "status", "timestamp"),
        day="2024-01-15",
    )


@query
def hourly_stats(spark, sf):
    return jobs.hourly_stats(
        b.event_orders(spark, sf, "product_name", "city", "total_amount", "timestamp"),
        b.payments(spark, sf, "status", "timestamp"),
    )


@query
def delivery_analysis(spark, sf):
    return jobs.delivery_analysis(b.deliveries(spark, sf, "city", "status", "estimated_days", "timestamp"))


@query
def delivery_insights(spark, sf):
    rows = b.deliveries(spark, sf, "city", "status", "estimated_days", "timestamp")
    return jobs.delivery_insights(jobs.delivery_counts(rows))


@query
def revenue_forecast(spark, sf):
    forecast = jobs.revenue_forecast(b.event_orders(spark, sf, "total_amount", "timestamp"))
    return forecast.withColumn("std_revenue", F.col("std_revenue").cast("decimal(22,2)"))


@query
def revenue_forecast_next_day(spark, sf):
    rows = b.event_orders(spark, sf, "total_amount", "timestamp")
    forecast = jobs.revenue_forecast(rows, day=now.EVENTS)
    return forecast.withColumn("std_revenue", F.col("std_revenue").cast("decimal(22,2)"))


@query
def forecast_report(spark, sf):
    rows = b.event_orders(spark, sf, "total_amount", "timestamp")
    return jobs.forecast_report(jobs.revenue_forecast(rows))


# --- events to tables -----------------------------------------------------------------------


def _messages(spark, sf):
    """All events as messages, each delivered twice."""
    first = b.messages(b.table(spark, sf, "events"))
    return first.unionByName(first.withColumn("offset", F.col("offset") + b.REDELIVERY))


@query
def parse_payload(spark, sf):
    payload = F.from_json("props", "k INT")
    return b.table(spark, sf, "events").select("event_id", payload["k"].alias("k"))


@query
def route_event_types(spark, sf):
    rows = medallion.routed(b.raw_events(spark, sf, "event_type"))
    return rows.groupBy(F.coalesce("route", F.lit("none")).alias("route"), "event_type").agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def bronze_events(spark, sf):
    rows = medallion.bronze_events(parse_events(_messages(spark, sf)))
    return rows.withColumn("payload_user", F.get_json_object("raw_payload", "$.user_id")).drop("raw_payload")


@query
def silver_orders(spark, sf):
    rows = medallion.silver_rows(parse_events(_messages(spark, sf)), medallion.silver_orders())
    return rows.drop("session_id", "state", "device")


@query
def silver_payments(spark, sf):
    return medallion.silver_rows(parse_events(_messages(spark, sf)), medallion.silver_payments()).drop("failure_reason")


@query
def silver_deliveries(spark, sf):
    return medallion.silver_rows(parse_events(_messages(spark, sf)), medallion.silver_deliveries())


@query
def current_deliveries(spark, sf):
    rows = medallion.silver_rows(parse_events(_messages(spark, sf)), medallion.silver_deliveries())
    return medallion.current_deliveries(rows)


@query
def refused_events(spark, sf):
    rows = medallion.refused_events(parse_events(b.messages(b.table(spark, sf, "events"))))
    return rows.select("topic", F.get_json_object("value", "$.event_id").alias("event_id"), "rejection_reason")


@query
def encode_events_(spark, sf):
    rows = b.raw_events(spark, sf, "event_id", "event_type", "user_id", "kafka_offset")
    return encode_events(rows).withColumn("topic", F.coalesce("topic", F.lit("none")))


@query
def schema_contract(spark, sf):
    rows = b.event_orders(
        spark, sf, "order_id", "event_id", "user_id", "product_id", "product_category", "quantity",
        "unit_price", "total_amount", "payment_method", "city", "event_time", "processed_at",
    )
    return conform(rows, ORDERS).drop("session_id", "state", "device")


@query
def product_dim(spark, sf):
    part = b.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("base_price"),
    )
    return with_seed(part)


@query
def dedupe_first(spark, sf):
    return first_per_key(b.order_lines(spark, sf, *LINE_COLUMNS), ["order_id", "line_no"], ["total_amount"])


@query
def insert_ignore_orders(spark, sf):
    """Returned lines are loaded first, then all lines: the loaded ones stay."""
    root = run_dir(spark, "insert")
    lines = b.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("total_amount"),
        "l_returnflag",
    )
    insert_ignore(lines.filter(F.col("l_returnflag") == "R").drop("l_returnflag"), LINES, root, ["total_amount"])
    insert_ignore(lines.drop("l_returnflag"), LINES, root, ["total_amount"])
    return read_table(spark, LINES, root).select(*LINE_COLUMNS)


@query
def upsert_daily_revenue(spark, sf):
    """All days as if nothing were cancelled, then the second half of the month corrected."""
    root = run_dir(spark, "upsert")
    rows = b.event_orders(spark, sf, *SILVER_COLUMNS)
    upsert(gold.daily_revenue(rows.withColumn("order_status", F.lit("placed"))), DAILY_REVENUE, root)
    late = rows.filter(F.col("event_time") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    upsert(gold.daily_revenue(late), DAILY_REVENUE, root)
    return read_table(spark, DAILY_REVENUE, root).drop("refreshed_at", "bucket_month")


# --- validation ---------------------------------------------------------------------------------


def _flat(spark, sf, topic):
    if topic == ORDERS_TOPIC:
        return b.orders(
            spark, sf, "order_id", "customer_id", "product_name", "price", "total_amount", "quantity", "status"
        )
    if topic == PAYMENTS_TOPIC:
        return b.payments(spark, sf, "payment_id", "order_id", "amount", "method", "status")
    rows = b.deliveries(spark, sf, "delivery_id", "order_id", "line_no", "city", "actual_days", "status")
    return rows.withColumnRenamed("actual_days", "estimated_days")


def _accepted(spark, sf, topic):
    return validate.valid_rows(validate.with_reason(_flat(spark, sf, topic), validate.rules_for(topic)))


def _rejected(spark, sf, topic, key):
    rows = validate.rejected_records(_flat(spark, sf, topic), topic)
    return rows.select("topic", F.get_json_object("record_data", f"$.{key}").alias(key), "rejection_reason")


@query
def validated_orders(spark, sf):
    return _accepted(spark, sf, ORDERS_TOPIC).select("order_id", "customer_id", "total_amount", "status")


@query
def validated_payments(spark, sf):
    return _accepted(spark, sf, PAYMENTS_TOPIC).select("payment_id", "amount", "method", "status")


@query
def validated_deliveries(spark, sf):
    return _accepted(spark, sf, DELIVERIES_TOPIC).select("delivery_id", "city", "estimated_days", "status")


@query
def rejected_orders(spark, sf):
    return _rejected(spark, sf, ORDERS_TOPIC, "order_id")


@query
def rejected_payments(spark, sf):
    return _rejected(spark, sf, PAYMENTS_TOPIC, "payment_id")


@query
def rejected_deliveries(spark, sf):
    return _rejected(spark, sf, DELIVERIES_TOPIC, "delivery_id")


@query
def reject_reason_counts(spark, sf):
    parts = [
        validate.rejected_records(_flat(spark, sf, t), t).select("topic", "rejection_reason")
        for t in (ORDERS_TOPIC, PAYMENTS_TOPIC, DELIVERIES_TOPIC)
    ]
    return validate.reason_counts(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query
def check_violations(spark, sf):
    rows = b.event_orders(
        spark, sf, "order_id", "user_id", "product_id", "quantity", "unit_price", "total_amount", "event_time"
    )
    return validate.rejected_rows(validate.check_constraints(rows, ORDERS)).select("order_id", "rejection_reason")


# --- joins ------------------------------------------------------------------------------------


@query
def orders_without_payment(spark, sf):
    return links.orders_without_payment(
        b.event_orders(spark, sf, "order_id", "total_amount", "timestamp"),
        b.payments(spark, sf, "payment_id", "order_id"),
    )


@query
def orphan_orders(spark, sf):
    return links.orphans(
        b.table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        b.table(spark, sf, "lineitem"),
        "o_orderkey",
        "l_orderkey",
    )


@query
def order_payment_join(spark, sf):
    return links.order_payments(
        b.event_orders(spark, sf, "order_id", "total_amount", "city"),
        b.payments(spark, sf, "payment_id", "order_id", "amount", "status"),
    )


@query
def apply_cancellations(spark, sf):
    placed = b.event_orders(spark, sf, "order_id", "total_amount").withColumn("order_status", F.lit("placed"))
    errors = b.table(spark, sf, "events").filter(F.col("event_type") == "error")
    cancelled = errors.select(F.col("event_id").cast("string").alias("order_id"))
    return medallion.apply_cancellations(placed, cancelled)


@query
def topic_throughput(spark, sf):
    return links.topic_throughput(b.messages(b.table(spark, sf, "events")))


# --- quality ------------------------------------------------------------------------------------


def _order_checks(spark, sf):
    rows = b.event_orders(spark, sf, "order_id", "user_id", "total_amount", "quantity", "event_time", "processed_at")
    return quality.silver_order_checks(rows, now.EVENTS, RUN)


def _bronze_checks(spark, sf):
    return quality.bronze_checks(b.raw_events(spark, sf, "event_id", "event_type", "ingested_at"), now.EVENTS, RUN)


def _payment_check(spark, sf):
    rows = b.payments(spark, sf, "payment_status", "processed_at")
    return quality.payment_failure_check(rows, now.EVENTS, RUN)


@query
def dq_bronze(spark, sf):
    return _bronze_checks(spark, sf)


@query
def dq_freshness(spark, sf):
    return quality.freshness_check(b.raw_events(spark, sf, "ingested_at"), now.EVENTS, RUN)


@query
def dq_silver_orders(spark, sf):
    return _order_checks(spark, sf)


@query
def dq_payment_failure(spark, sf):
    return _payment_check(spark, sf)


@query
def dq_summary(spark, sf):
    log = _bronze_checks(spark, sf).unionByName(_order_checks(spark, sf)).unionByName(_payment_check(spark, sf))
    return quality.dq_summary(quality.stamped(log, now.EVENTS), now.EVENTS)


@query
def dq_daily_report(spark, sf):
    return quality.daily_quality_report(
        b.event_orders(
            spark, sf, "order_id", "customer_id", "product_name", "total_amount", "price", "quantity", "timestamp"
        ),
        b.payments(spark, sf, "payment_id", "order_id", "status", "timestamp"),
    )


# --- writes that are repeated ------------------------------------------------------------------------


@query
def insert_ignore_across_days(spark, sf):
    """The second delivery of every message says another day; the stored rows stay."""
    root = run_dir(spark, "days")
    events = b.table(spark, sf, "events")
    event_tables.write_batch(b.messages(events), root)
    moved = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY")).withColumn("copy", F.lit(1))
    event_tables.write_batch(b.messages(moved), root)
    keys = ((RAW_EVENTS, "event_id"), (ORDERS, "order_id"), (PAYMENTS, "payment_id"))
    parts = [
        read_table(spark, t, root).select(F.lit(t.name).alias("table_name"), F.col(k).alias("id"), "event_time")
        for t, k in keys
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def message_outcomes(spark, sf):
    """Each message is stored, kept raw or refused, and only one of them."""
    root = run_dir(spark, "outcomes")
    value, n = F.col("value"), F.col("offset") % 50
    broken = F.when(n == 7, F.regexp_replace(value, '"event_id":"[^"]*",', "")).when(
        n == 8, F.regexp_replace(value, '"total_amount":[^,]*,', '"total_amount":1.0E15,')
    )
    messages = b.messages(b.table(spark, sf, "events"))
    event_tables.write_batch(messages.withColumn("value", F.coalesce(broken, value)), root)
    number = lambda c: F.regexp_extract(c, "(\\d+)", 1).cast("long").alias("id")
    stored = [read_table(spark, t, root).select(number("order_id")) for t in (ORDERS, PAYMENTS, DELIVERIES)]
    stored = stored[0].unionByName(stored[1]).unionByName(stored[2])
    refused = read_table(spark, REJECTED, root).select(
        F.col("kafka_offset").alias("id"), F.col("rejection_reason").alias("outcome")
    )
    raw = read_table(spark, RAW_EVENTS, root).select(number("event_id"))
    raw = raw.join(stored, "id", "left_anti").join(refused, "id", "left_anti")
    return (
        stored.withColumn("outcome", F.lit("stored"))
        .unionByName(raw.withColumn("outcome", F.lit("raw")))
        .unionByName(refused)
    )


def _twice(refresh):
    """Two refreshes of one table, off the hour and a day apart."""
    for as_of in now.REFRESHES:
        refresh(as_of)


@query
def refresh_hourly_revenue(spark, sf):
    root = run_dir(spark, "refresh")

    def refresh(as_of):
        rows = b.event_orders(spark, sf, *SILVER_COLUMNS).filter(F.col("event_time") <= F.lit(as_of))
        since = F.date_trunc("hour", before(as_of, gold.REFRESH_PERIOD))
        replace_range(gold.hourly_revenue(rows, as_of, whole_hours=True), HOURLY_REVENUE, root, since)

    _twice(refresh)
    return read_table(spark, HOURLY_REVENUE, root).drop("refreshed_at", "bucket_date")


@query
def refresh_payment_failures(spark, sf):
    root = run_dir(spark, "refresh")

    def refresh(as_of):
        rows = b.payments(spark, sf, "payment_method", "payment_status", "event_time")
        rows = rows.filter(F.col("event_time") <= F.lit(as_of))
        since = F.date_trunc("hour", before(as_of, gold.REFRESH_PERIOD))
        replace_range(gold.payment_failure_metrics(rows, as_of, whole_hours=True), PAYMENT_FAILURES, root, since)

    _twice(refresh)
    return read_table(spark, PAYMENT_FAILURES, root).drop("refreshed_at", "bucket_date")


@query
def refresh_delayed_shipments(spark, sf):
    """A delivery moves from the day it was shipped to the day it arrived."""
    root = run_dir(spark, "refresh")

    def refresh(as_of):
        events = b.table(spark, sf, "events").filter(F.col("ts") <= F.lit(as_of))
        rows = medallion.silver_rows(parse_events(b.messages(events)), medallion.silver_deliveries())
        replace_range(gold.delayed_shipments(medallion.current_deliveries(rows)), DELAYED_SHIPMENTS, root)

    _twice(refresh)
    return read_table(spark, DELAYED_SHIPMENTS, root).drop("refreshed_at", "bucket_month")


@query
def refresh_city_revenue(spark, sf):
    """Cancellations become known after the first refresh; the second covers the later half."""
    root = run_dir(spark, "refresh")
    rows = b.event_orders(spark, sf, "city", "order_status", "total_amount", "event_time")
    replace_range(gold.revenue_by_city(rows.withColumn("order_status", F.lit("placed"))), REVENUE_BY_CITY, root)
    since = F.lit("2024-01-16").cast("date")
    replace_range(gold.revenue_by_city(rows), REVENUE_BY_CITY, root, since)
    return read_table(spark, REVENUE_BY_CITY, root).drop("refreshed_at", "bucket_month")


@query
def refresh_customer_metrics(spark, sf):
    """Customers whose orders were all cancelled after the first refresh go."""
    root = run_dir(spark, "refresh")
    rows = b.event_orders(spark, sf, *SILVER_COLUMNS)
    for known in (rows.withColumn("order_status", F.lit("placed")), rows):
        replace_range(gold.customer_metrics(known, now.EVENTS), CUSTOMER_METRICS, root)
    return read_table(spark, CUSTOMER_METRICS, root).drop("refreshed_at", "key_bucket")


@query
def refresh_segments(spark, sf):
    root = run_dir(spark, "refresh")
    rows = _segments(spark, sf)
    replace_range(rows.withColumn("segment", F.lit("Old")), CUSTOMER_SEGMENTS, root)
    replace_range(rows, CUSTOMER_SEGMENTS, root)
    return read_table(spark, CUSTOMER_SEGMENTS, root).drop("created_at", "key_bucket")


@query
def delta_delayed_shipments(spark, sf):
    """Late shipments from three deltas of events; the last one is applied twice."""
    root = run_dir(spark, "deltas")
    events = b.table(spark, sf, "events")
    borders = ("2024-01-10 00:00:00", *now.REFRESHES)
    for k, (since, until) in enumerate(zip((None, *borders), borders)):
        part = events.filter(F.col("ts") <= F.lit(until))
        part = part if since is None else part.filter(F.col("ts") > F.lit(since))
        rows = medallion.silver_rows(parse_events(b.messages(part)), medallion.silver_deliveries())
        for _ in range(2 if until == borders[-1] else 1):
            incremental.add_deliveries(rows, root, f"delta-{k}")
            incremental.refresh_delayed_shipments(spark, root)
    return read_table(spark, DELAYED_SHIPMENTS, root).drop("refreshed_at", "bucket_month")


@query
def delta_customer_metrics(spark, sf):
    """Orders come as placed in two deltas, then a third takes the cancelled ones out."""
    root = run_dir(spark, "deltas")
    rows = b.event_orders(spark, sf, *SILVER_COLUMNS)
    half = F.col("event_time") < F.lit("2024-01-16").cast("timestamp")
    deltas = ({"placed": rows.where(half)}, {"placed": rows.where(~half)}, {"cancelled": rows.where("order_status = 'cancelled'")})
    for k, delta in enumerate(deltas):
        incremental.add_orders(root, f"delta-{k}", **delta)
        incremental.refresh_customer_metrics(spark, root)
    return incremental.customer_metrics(spark, root, now.EVENTS).drop("refreshed_at", "key_bucket")


CUBE_COLUMNS = ("customer_id", "total_amount", "city", "category", "status", "timestamp")
FILTERS = (
    {},
    {"city": "NATION_7"},
    {"category": "2-HIGH", "date_from": "1996-01-01"},
    {"city": "NATION_7", "category": "2-HIGH", "date_from": "1996-01-01", "date_to": "2000-12-31"},
    {"date_from": "1997-03-05", "date_to": "1997-03-20", "inclusive_end": True},
)


def _cube(spark, sf, customers=False):
    """The kept figures after three deltas: two halves as placed, then the states as they are."""
    root = run_dir(spark, "cube")
    rows = b.orders(spark, sf, *CUBE_COLUMNS)
    placed = rows.withColumn("status", F.lit("placed"))
    half = F.col("timestamp") < F.lit("1998-05-05").cast("timestamp")
    for k, part in enumerate((placed.where(half), placed.where(~half))):
        cube.add_orders(root, f"delta-{k}", part)
        if customers:
            cube.add_customers(part, root, f"delta-{k}")
    changed = F.col("status") != "placed"
    cube.add_orders(root, "states", rows.where(changed), rows.where(changed).withColumn("status", F.lit("placed")))
    return root


@query
def cube_reports(spark, sf):
    """Four reports with five filters each, all from the cube."""
    root = _cube(spark, sf)
    reports = {"city": cube.revenue_by_city, "category": cube.category_sales, "status": cube.order_status, "month": cube.monthly_revenue}
    parts = []
    for number, filters in enumerate(FILTERS):
        for name, report in reports.items():
            key, value = (rows := report(spark, root, **filters)).columns
            parts.append(rows.select(
                F.lit(number).alias("filter"), F.lit(name).alias("report"), F.col(key).alias("key"), F.col(value).cast("decimal(24,2)").alias("value")
            ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def cube_summaries(spark, sf):
    """Headline figures with five filters; customers are counted in bitmaps."""
    root = _cube(spark, sf, customers=True)
    parts = [cube.summary(spark, root, **f).withColumn("filter", F.lit(k)) for k, f in enumerate(FILTERS)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def gold_with_cancellations(spark, sf):
    """From messages to the daily figures, without the orders cancelled later."""
    root = run_dir(spark, "cancelled")
    events = b.table(spark, sf, "events")
    event_tables.write_batch(b.messages(events).unionByName(b.cancel_messages(events)), root)
    raw = read_table(spark, RAW_EVENTS, root).select(
        F.col("raw_payload").alias("value"), F.col("kafka_topic").alias("topic")
    )
    refresh_gold(spark, root, now.EVENTS, cancelled=medallion.cancellations(parse_events(raw)))
    return read_table(spark, DAILY_REVENUE, root).drop("refreshed_at", "bucket_month")


# --- streams --------------------------------------------------------------------------------------


def _finish(stream_query) -> None:
    stream_query.awaitTermination()


def _events(spark, sf, again=False, late=None):
    return b.replay(spark, sf, "events", "ts", late, again)


def _late(spark, sf):
    """The first purchase, which the replay delivers last."""
    bought = b.table(spark, sf, "events").filter("event_type = 'purchase'")
    first = bought.agg(F.min(F.struct("ts", "event_id")).alias("first")).select("first.event_id").first()[0]
    return F.col("event_id") == first


@query
def stream_events_bronze(spark, sf):
    root = run_dir(spark, "bronze")
    parsed = parse_events(b.messages(_events(spark, sf)))
    rows = parsed.select(
        "event_id", "event_type", F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), "event_time",
    )
    _finish(windows.to_files(rows, f"{root}/table", f"{root}/checkpoint", trigger=None))
    return spark.read.schema(rows.schema).parquet(f"{root}/table").select(*rows.columns)


@query
def stream_medallion(spark, sf):
    """Every message comes again in the next batch."""
    root = run_dir(spark, "events")
    messages = b.messages(_events(spark, sf, again=True))
    _finish(event_tables.run(messages, root, f"{root}/checkpoint", trigger=None))

    def counted(table, amount):
        rows = read_table(spark, table, root)
        return rows.groupBy(F.lit(table.name).alias("table_name"), "event_date").agg(
            F.count(F.lit(1)).alias("records"), F.sum(amount).cast("decimal(22,2)").alias("amount")
        )

    return (
        counted(RAW_EVENTS, F.lit(0))
        .unionByName(counted(ORDERS, F.col("total_amount")))
        .unionByName(counted(PAYMENTS, F.col("amount")))
        .unionByName(counted(DELIVERIES, F.col("actual_days")))
    )


def _outcomes(spark, messages, topic, key):
    """Runs the validated stream of a topic; accepted and refused keys of the written tables."""
    root = run_dir(spark, "validated")
    _finish(flat_tables.run(messages, topic, root, f"{root}/checkpoint", trigger=None))
    good = read_table(spark, FLAT_TABLES[topic], root).select(key, F.lit("accepted").alias("outcome"))
    bad = read_table(spark, REJECTED, root).select(
        F.get_json_object("record_data", f"$.{key}").alias(key), F.col("rejection_reason").alias("outcome")
    )
    return good.unionByName(bad)


@query
def stream_validated_orders(spark, sf):
    messages = b.flat_order_messages(b.replay(spark, sf, "orders", "o_orderdate"))
    return _outcomes(spark, messages, ORDERS_TOPIC, "order_id")


@query
def stream_validated_payments(spark, sf):
    return _outcomes(spark, b.flat_payment_messages(_events(spark, sf)), PAYMENTS_TOPIC, "payment_id")


@query
def stream_validated_deliveries(spark, sf):
    lines = b.with_city(b.replay(spark, sf, "lineitem", "l_shipdate"), spark, sf)
    return _outcomes(spark, b.flat_delivery_messages(lines), DELIVERIES_TOPIC, "delivery_id")


@query
def stream_insert_ignore(spark, sf):
    """Every order comes again in the next batch."""
    root = run_dir(spark, "flat")
    messages = b.flat_order_messages(b.replay(spark, sf, "orders", "o_orderdate", again=True))
    _finish(flat_tables.run(messages, ORDERS_TOPIC, root, f"{root}/checkpoint", validate=False, trigger=None))
    return read_table(spark, FLAT_ORDERS, root).select("order_id", "total_amount", "status", "timestamp")


@query
def stream_dedupe(spark, sf):
    """Each event comes twice in a batch and twice in the next one; the late one is left out."""
    root = run_dir(spark, "dedupe")
    events = _events(spark, sf, again=True, late=_late(spark, sf)).select(
        "event_id", F.col("ts").cast("timestamp").alias("event_time"),
        (F.col("event_id") + F.col("copy") * b.REDELIVERY).alias("offset"),
    )
    twice = events.withColumn("offset", F.col("offset") + 2 * b.REDELIVERY).unionByName(events)
    rows = windows.first_copies(twice, ["event_id"], ["offset"], "event_time", "12 hours")
    _finish(windows.to_files(rows, f"{root}/table", f"{root}/checkpoint", trigger=None))
    return spark.read.schema(rows.schema).parquet(f"{root}/table").select(*rows.columns)


@query
def stream_hourly_revenue(spark, sf):
    """The late purchase is left to the batch refresh."""
    root = run_dir(spark, "hourly")
    events = _events(spark, sf, late=_late(spark, sf)).withColumn("ts", F.col("ts").cast("timestamp"))
    orders = b.event_orders_from(events, "product_category", "order_status", "total_amount", "event_time")
    _finish(windows.run_hourly_revenue(orders, root, f"{root}/checkpoint", "12 hours", trigger=None))
    return read_table(spark, HOURLY_REVENUE, root).drop("refreshed_at", "bucket_date")


@query
def stream_topic_throughput(spark, sf):
    root = run_dir(spark, "throughput")
    messages = b.messages(_events(spark, sf, late=_late(spark, sf))).withWatermark("timestamp", "12 hours")
    counts = links.topic_throughput(messages)
    _finish(windows.keep_table(counts, TOPIC_THROUGHPUT, root, f"{root}/checkpoint", trigger=None))
    return read_table(spark, TOPIC_THROUGHPUT, root).drop("slot_date")




@query
def stream_unpaid_orders(spark, sf):
    """Purchases and sign-ups are paid up to two hours later, other orders never; an hour is in time."""
    root = run_dir(spark, "unpaid")
    orders = b.event_orders_from(_events(spark, sf), "order_id", "total_amount", "event_time")
    orders = orders.withColumn("event_time", F.col("event_time").cast("timestamp"))
    paid = _events(spark, sf).filter(F.col("event_type").isin("purchase", "signup"))
    order_id = F.col("event_id").cast("string")
    after = F.make_dt_interval(mins=(F.col("event_id") % 121).cast("int"))
    payments = paid.select(
        order_id.alias("payment_id"), order_id.alias("order_id"), (F.col("ts").cast("timestamp") + after).alias("event_time")
    )
    _finish(unpaid.run(orders, payments, f"{root}/table", f"{root}/checkpoint", trigger=None, within="60 minutes", delay="12 hours"))
    return spark.read.schema(orders.schema).parquet(f"{root}/table").select(*orders.columns)


@query
def stream_observed_checks(spark, sf):
    """The log of a stream's checks, added up over its batches; the first batch is logged twice."""
    root = run_dir(spark, "observed")
    parsed = parse_events(b.messages(_events(spark, sf))).withColumns(
        # every 40th event has lost its id, every 30th its type
        {
            "event_id": F.when(F.col("offset") % 40 != 0, F.col("event_id")),
            "event_type": F.when(F.col("offset") % 30 == 0, None).when(F.col("offset") % 7 == 0, "other").otherwise(F.col("event_type")),
        }
    ).select("event_id", "event_type", "offset")

    def write(rows, number):
        rows.write.mode("overwrite").parquet(f"{root}/raw/batch_number={number}")

    checks = checked.raw_event_checks()
    _finish(checked.run(parsed, write, root, f"{root}/checkpoint", "raw", checks, trigger=None))
    first = spark.read.schema(parsed.schema).parquet(f"{root}/raw/batch_number=0")
    checked.logged_write(first, lambda rows: write(rows, 99), checks, "bronze", "raw_events", root, "raw-0")
    log = read_table(spark, DQ_RUN_LOG, root)
    return log.groupBy("layer", "table_name", "check_name").agg(
        F.sum("records_checked").alias("records_checked"), F.sum("records_failed").alias("records_failed")
    )


@query
def append_twice(spark, sf):
    """Plain appends into tables that are created where they are absent: every row is there twice."""
    root = run_dir(spark, "append")
    create_all(spark, root)
    rows = b.payments(spark, sf, "payment_id", "order_id", "amount", "method", "status", "timestamp")
    for _ in range(2):
        append(rows, FLAT_PAYMENTS, root)
        create_all(spark, root)  # tables that exist stay as they are
    stored = read_table(spark, FLAT_PAYMENTS, root)
    return stored.groupBy("method", "status").agg(
        F.count(F.lit(1)).alias("payments"), F.count_distinct("payment_id").alias("ids"), F.sum("amount").alias("amount")
    )


@query
def audit_log(spark, sf):
    """Check runs of the layers and daily reports, logged on two days."""
    root = run_dir(spark, "audit")
    for run_at in ("2024-01-30", now.EVENTS):
        for log in (_bronze_checks(spark, sf), _order_checks(spark, sf), _payment_check(spark, sf)):
            append(quality.stamped(log, run_at), DQ_RUN_LOG, root)
        append(dq_daily_report(spark, sf), DATA_QUALITY_LOG, root)
    runs = read_table(spark, DQ_RUN_LOG, root).groupBy(
        F.col("table_name").alias("subject"), F.col("check_name").alias("detail"), F.upper("status").alias("status")
    )
    days = read_table(spark, DATA_QUALITY_LOG, root).groupBy(
        F.lit("day").alias("subject"), F.col("check_date").cast("string").alias("detail"), "status"
    )
    counted = (
        runs.agg(F.count(F.lit(1)).alias("entries"), F.sum("records_failed").alias("failures")),
        days.agg(F.count(F.lit(1)).alias("entries"), F.sum(F.col("null_values") + F.col("negative_amounts")).alias("failures")),
    )
    return counted[0].unionByName(counted[1])


@query
def catch_up_positions(spark, sf):
    """A consumer group reads half of the messages, then the others; each message is handled once."""
    root = run_dir(spark, "groups")
    messages = b.messages(b.table(spark, sf, "events")).select("topic", "partition", "offset", "value")
    group = ConsumerGroup(spark, root, "reporting")
    last = messages.agg(F.max("offset")).first()[0]
    for number, seen in enumerate((messages.where(F.col("offset") <= last // 2), messages, messages)):
        group.catch_up(seen, lambda rows: rows.write.parquet(f"{root}/handled/run={number}"))
    handled = spark.read.schema(messages.schema).parquet(f"{root}/handled")
    return handled.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("offset").alias("offsets"), F.max("offset").alias("last")
    )


@query
def revenue_forecast_by_city(spark, sf):
    rows = b.event_orders(spark, sf, "city", "product_category", "total_amount", "timestamp")
    forecast = jobs.revenue_forecast(rows, by=["city", "product_category"])
    return forecast.withColumn("std_revenue", F.col("std_revenue").cast("decimal(22,2)"))


QUERIES["encode_events"] = QUERIES.pop("encode_events_")
