"""Positions of consumer groups, and the log of a stream's checks."""

import json

import pytest
from pyspark.sql import functions as F
from test_streaming import event, messages, order

from souk.operators.quality import raise_on_failure
from souk.plans.gold_refresh import refresh_gold
from souk.sources.positions import ConsumerGroup, ending_offsets, ends_of
from souk.sources.schemas import DAILY_REVENUE, DQ_RUN_LOG, ORDERS_TOPIC, PAYMENTS_TOPIC
from souk.sources.tables import read_table
from souk.streaming import checked, event_tables


def placed(spark, offsets, topic="t"):
    return spark.createDataFrame([(topic, o % 2, o) for o in offsets], "topic STRING, partition INT, offset LONG")


def test_each_message_is_handled_once(spark, root):
    handled = []
    take = lambda rows: handled.extend((r.topic, r.offset) for r in rows.collect())
    for offsets in (range(10), range(10), range(4, 25), []):
        ConsumerGroup(spark, root, "a").catch_up(placed(spark, offsets), take)
    ConsumerGroup(spark, root, "a").catch_up(placed(spark, range(6), "new topic"), take)
    assert sorted(handled) == sorted([("t", o) for o in range(25)] + [("new topic", o) for o in range(6)])
    assert ConsumerGroup(spark, root, "a").positions() == {"t": {0: 25, 1: 24}, "new topic": {0: 5, 1: 6}}
    ConsumerGroup(spark, root, "b").catch_up(placed(spark, range(3)), take)  # another group begins for itself
    assert len(handled) == 34


def test_failed_run_commits_nothing(spark, root):
    group = ConsumerGroup(spark, root, "a")
    with pytest.raises(ZeroDivisionError):
        group.catch_up(placed(spark, range(5)), lambda rows: 1 / 0)
    assert group.positions() == {}
    handled = []
    group.catch_up(placed(spark, range(5)), lambda rows: handled.extend(r.offset for r in rows.collect()))
    assert sorted(handled) == list(range(5))


def test_latest_starts_at_the_end(spark, root):
    handled = []
    take = lambda rows: handled.extend(r.offset for r in rows.collect())
    group = ConsumerGroup(spark, root, "late", start="latest")
    group.catch_up(placed(spark, range(10)), take)
    group.catch_up(placed(spark, range(15)), take)
    assert sorted(handled) == list(range(10, 15))
    with pytest.raises(ValueError, match="earliest or latest"):
        ConsumerGroup(spark, root, "x", start="middle")


def test_options_for_kafka(spark, root):
    group = ConsumerGroup(spark, root, "k")
    group.commit({"t": {0: 7}})
    group.commit({"t": {0: 5, 1: 3}})  # no position goes back
    assert json.loads(group.starting_offsets({"t": [0, 1, 2], "u": [0]})) == {"t": {"0": 7, "1": 3, "2": -2}, "u": {"0": -2}}
    late = ConsumerGroup(spark, root, "k", start="latest")
    assert json.loads(late.starting_offsets({"t": [2]})) == {"t": {"2": -1}}
    assert json.loads(ending_offsets(ends_of(placed(spark, [4, 9])))) == {"t": {"0": 5, "1": 10}}


def test_repeated_batch_adds_no_log_rows(spark, root, tmp_path):
    rows = spark.createDataFrame([("e1", "order_placed"), (None, "other"), ("e3", None)], "event_id STRING, event_type STRING")
    for _ in range(2):
        checked.logged_write(rows, lambda df: df.write.mode("overwrite").parquet(f"{tmp_path}/out"), checked.raw_event_checks(), "bronze", "raw_events", root, "s-0")
    log = read_table(spark, DQ_RUN_LOG, root)
    assert {(r.check_name, r.status, r.records_checked, r.records_failed) for r in log.collect()} == {
        ("no_null_event_ids", "failed", 3, 1), ("no_null_event_types", "failed", 3, 1), ("valid_event_types", "failed", 3, 1),
    }
    assert log.count() == 3
    checked.logged_write(rows.limit(0), lambda df: df.write.mode("overwrite").parquet(f"{tmp_path}/out"), checked.raw_event_checks(), "bronze", "raw_events", root, "s-1")
    assert {r.status for r in read_table(spark, DQ_RUN_LOG, root).where("run_id = 's-1'").collect()} == {"passed"}
    with pytest.raises(ValueError):
        raise_on_failure(log)


def test_refresh_leaves_out_cancelled_orders(spark, root):
    rows = [(ORDERS_TOPIC, order(f"e{i}", f"o{i}", total_amount=float(i))) for i in (1, 2, 4)]
    rows += [(ORDERS_TOPIC, event("c1", "order_cancelled", order_id="o2")), (PAYMENTS_TOPIC, event("p", "payment_failed", payment_id="p1", amount=1.0))]
    event_tables.write_batch(messages(spark, rows), root)
    refresh_gold(spark, root, "2024-01-02")
    assert [(float(r.total_revenue), r.order_count) for r in read_table(spark, DAILY_REVENUE, root).collect()] == [(5.0, 2)]
    none = spark.createDataFrame([], "order_id STRING")
    refresh_gold(spark, root, "2024-01-02", cancelled=none)
    assert [r.order_count for r in read_table(spark, DAILY_REVENUE, root).where(F.col("total_revenue") > 0).collect()] == [3]
