"""What the physical plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from souk.functions.grouping import first_per_key
from souk.operators import links, medallion
from souk.registry.queries import QUERIES
from souk.sinks import writers
from souk.sources.schemas import TOPIC_THROUGHPUT
from souk.sources.tables import conform

SF_DIR = "/root/testdata/sf0.001"
WRITERS = {"insert_ignore_orders", "upsert_daily_revenue", "insert_ignore_across_days", "message_outcomes", "gold_with_cancellations"}
READERS = [n for n in QUERIES if not n.startswith(("stream_", "refresh_")) and n not in WRITERS]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", READERS)
def test_no_pair_products_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in text


@pytest.mark.parametrize(
    "name, columns",
    [
        ("category_sales", {"o_totalprice", "o_orderpriority"}),
        ("order_status", {"o_orderstatus"}),
        ("dq_freshness", {"ts"}),
        ("monthly_revenue", {"o_totalprice", "o_orderdate"}),
        ("payment_failure_metrics", {"ts", "user_id", "event_type"}),
    ],
)
def test_scan_reads_needed_columns_only(spark, name, columns):
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, SF_DIR)))
    assert {c.split(":")[0] for c in schema.split(",")} == columns


@pytest.mark.parametrize(
    "name", ["daily_revenue_series", "hourly_revenue", "summary_last_30d", "dq_bronze", "daily_sales_one_day"]
)
def test_time_filters_reach_the_scan(spark, name):
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual", plan(QUERIES[name](spark, SF_DIR)))


@pytest.mark.parametrize("name", ["top_products", "top_cities", "inventory_alert", "churn_high_value", "forecast_report"])
def test_top_k_does_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR))


def test_each_message_is_parsed_once(spark):
    text = plan(QUERIES["silver_orders"](spark, SF_DIR))
    assert text.count("from_json(") == 3  # one parser per topic


@pytest.fixture
def small_limits(spark):
    limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_orders(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    return spark.range(120_000, numPartitions=8).select(
        key.alias("order_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit("placed").alias("order_status")
    )


def test_hot_key_is_split_in_joins(spark, small_limits):
    orders = hot_orders(spark)
    ids = orders.select("order_id", F.lit("p").alias("payment_id")).filter("order_id <> '7'")
    joined = {
        "unpaid": links.orders_without_payment(orders, ids),
        "orphans": links.orphans(orders, ids, "order_id"),
        "cancelled": medallion.apply_cancellations(orders, ids).withColumn("text", F.concat("text", "order_status")),
    }
    for name, df in joined.items():
        result = df.groupBy().agg(F.max("text"))
        result.collect()
        assert "skew" in plan(result).lower(), name


def test_copies_are_reduced_before_the_shuffle(spark, small_limits):
    text = plan(first_per_key(hot_orders(spark), ["order_id"], ["text"]))
    assert text.index("partial_min") > text.index("Exchange")  # printed top down: below the exchange


@pytest.mark.parametrize("name", ["category_forecast", "delivery_insights"])
def test_no_sort_of_all_rows_below_an_aggregate(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    below = text[text.index("HashAggregate") if "HashAggregate" in text else text.index("Aggregate"):]
    assert "rangepartitioning" not in below


def test_spread_deals_a_day_over_tasks(spark, tmp_path, monkeypatch):
    seen = []
    from pyspark.sql.readwriter import DataFrameWriter

    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: seen.append(plan(self._df)))
    start, topic = F.timestamp_seconds("id").alias("slot_start"), F.col("id").cast("string").alias("topic")
    rows = spark.range(10).select(start, topic, F.col("id").alias("messages"))
    writers._write(conform(rows, TOPIC_THROUGHPUT), TOPIC_THROUGHPUT, f"file://{tmp_path}", "append", spread=16)
    assert re.search(r"hashpartitioning\(slot_date.*REPARTITION_BY_COL", seen[0])
