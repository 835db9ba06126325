"""Keyed writers: idempotence, NULL keys, order independence, untouched partitions."""

import random

import pytest
from pyspark.sql import functions as F

from souk.functions.grouping import first_per_key, last_per_key
from souk.sinks.writers import append, encode_events, insert_ignore, kafka_writer, replace_range, upsert
from souk.sources.schemas import FLAT_ORDERS, FLAT_PAYMENTS, HOURLY_REVENUE, PRODUCTS, RAW_EVENTS, TABLES
from souk.sources.tables import conform, create_all, read_table


def hours(spark, rows):
    df = spark.createDataFrame(rows, "hour STRING, product_category STRING, total_revenue STRING, order_count INT")
    return df.withColumn("hour_bucket", F.col("hour").cast("timestamp")).withColumn("avg_order_value", F.lit(1))


def content(spark, root):
    rows = read_table(spark, HOURLY_REVENUE, root).collect()
    return sorted((str(r.hour_bucket), r.product_category or "-", float(r.total_revenue)) for r in rows)


FIRST = [("2024-01-01 10:00", "A", "1", 1), ("2024-01-01 11:00", None, "2", 1), ("2024-01-02 10:00", "A", "3", 1)]
SECOND = [("2024-01-01 11:00", None, "20", 2), ("2024-01-01 12:00", "B", "4", 1)]


def test_upsert_replaces_adds_and_keeps(spark, root):
    upsert(hours(spark, FIRST), HOURLY_REVENUE, root)
    upsert(hours(spark, SECOND), HOURLY_REVENUE, root)
    once = content(spark, root)
    assert once == [
        ("2024-01-01 10:00:00", "A", 1.0), ("2024-01-01 11:00:00", "-", 20.0),
        ("2024-01-01 12:00:00", "B", 4.0), ("2024-01-02 10:00:00", "A", 3.0),
    ]
    upsert(hours(spark, SECOND), HOURLY_REVENUE, root)
    assert content(spark, root) == once


def test_upsert_leaves_other_partitions_untouched(spark, root, tmp_path):
    upsert(hours(spark, FIRST), HOURLY_REVENUE, root)
    day = tmp_path / "tables/gold/hourly_revenue/bucket_date=2024-01-02"
    before = {p.name: p.stat().st_mtime_ns for p in day.iterdir()}
    upsert(hours(spark, SECOND), HOURLY_REVENUE, root)
    assert {p.name: p.stat().st_mtime_ns for p in day.iterdir()} == before


def test_upsert_refuses_partition_that_moves_with_the_row(spark, root):
    with pytest.raises(ValueError):
        upsert(spark.range(1), FLAT_ORDERS, root)


def test_replace_range_drops_what_is_gone(spark, root, tmp_path):
    upsert(hours(spark, FIRST), HOURLY_REVENUE, root)
    since = F.lit("2024-01-01 11:00").cast("timestamp")
    replace_range(hours(spark, [("2024-01-01 12:00", "B", "4", 1)]), HOURLY_REVENUE, root, since)
    # the older hour of the first partition stays, its other hours and the next day go
    assert content(spark, root) == [("2024-01-01 10:00:00", "A", 1.0), ("2024-01-01 12:00:00", "B", 4.0)]
    assert not (tmp_path / "tables/gold/hourly_revenue/bucket_date=2024-01-02").exists()
    replace_range(hours(spark, FIRST).limit(0), HOURLY_REVENUE, root)
    assert content(spark, root) == []


def test_failed_replace_leaves_the_old_rows(spark, root):
    upsert(hours(spark, FIRST), HOURLY_REVENUE, root)
    before = content(spark, root)
    failing = hours(spark, SECOND).withColumn("order_count", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        replace_range(failing, HOURLY_REVENUE, root)
    assert content(spark, root) == before


def test_spread_writes_the_same_rows(spark, root):
    upsert(hours(spark, FIRST), HOURLY_REVENUE, root, spread=4)
    upsert(hours(spark, SECOND), HOURLY_REVENUE, root, spread=4)
    assert len(content(spark, root)) == 4


def test_insert_ignore_finds_keys_on_other_days(spark, root):
    def event(day):
        rows = spark.createDataFrame([("e1", "order_placed", "{}", day)], "event_id STRING, event_type STRING, raw_payload STRING, t STRING")
        return rows.withColumn("event_time", F.col("t").cast("timestamp"))

    for day in ("2024-01-01 23:59:59", "2024-01-02 00:00:01"):
        insert_ignore(event(day), RAW_EVENTS, root)
    assert [str(r.event_date) for r in read_table(spark, RAW_EVENTS, root).collect()] == ["2024-01-01"]


def flat(spark, rows):
    df = spark.createDataFrame(rows, "order_id STRING, total_amount STRING, ts STRING, offset LONG")
    return df.withColumn("timestamp", F.col("ts").cast("timestamp"))


def test_insert_ignore_first_wins_across_days_and_runs(spark, root):
    rows = [("a", "1", "2024-01-01", 1), ("a", "2", "2024-01-02", 2), ("b", "3", "2024-01-01", 3)]
    insert_ignore(flat(spark, rows), FLAT_ORDERS, root, ["offset"])
    late = [("a", "9", "2024-02-01", 0), ("c", "5", "2024-02-01", 9)]
    for _ in range(2):
        insert_ignore(flat(spark, late), FLAT_ORDERS, root, ["offset"])
    got = sorted((r.order_id, float(r.total_amount)) for r in read_table(spark, FLAT_ORDERS, root).collect())
    assert got == [("a", 1.0), ("b", 3.0), ("c", 5.0)]


def test_insert_ignore_does_not_depend_on_row_order(spark, tmp_path):
    rows = [(random.Random(i).choice("abcd"), str(i), "2024-01-01", i) for i in range(40)]
    results = []
    for seed in (1, 2):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        folder = f"file://{tmp_path}/{seed}"
        insert_ignore(flat(spark, shuffled).repartition(3), FLAT_ORDERS, folder, ["offset"])
        results.append(sorted(map(str, read_table(spark, FLAT_ORDERS, folder).collect())))
    assert results[0] == results[1] and len(results[0]) == 4


def test_repeated_insert_changes_nothing(spark, root):
    event = spark.createDataFrame([("e1", "order_placed", "{}", "2024-01-01 10:00")], "event_id STRING, event_type STRING, raw_payload STRING, t STRING")
    event = event.withColumn("event_time", F.col("t").cast("timestamp"))
    for _ in range(3):
        insert_ignore(event, RAW_EVENTS, root)
    assert read_table(spark, RAW_EVENTS, root).count() == 1


def test_null_partition_value(spark, root):
    rows = flat(spark, [("a", "1", None, 1), ("b", "1", "2024-01-01", 2)])
    insert_ignore(rows, FLAT_ORDERS, root)
    insert_ignore(rows, FLAT_ORDERS, root, everywhere=False)
    assert read_table(spark, FLAT_ORDERS, root).count() == 2


def test_unpartitioned_insert_ignore(spark, root):
    rows = spark.createDataFrame([("p1", "x", "c", 1), ("p1", "y", "c", 2)], "product_id STRING, product_name STRING, category STRING, base_price INT")
    for _ in range(2):
        insert_ignore(rows, PRODUCTS, root, ["base_price"])
    assert [r.product_name for r in read_table(spark, PRODUCTS, root).collect()] == ["x"]


def test_append_keeps_everything(spark, root):
    rows = spark.createDataFrame([("p", "o")], "payment_id STRING, order_id STRING")
    for _ in range(2):
        append(rows, FLAT_PAYMENTS, root)
    assert read_table(spark, FLAT_PAYMENTS, root).count() == 2


def test_all_tables_can_be_created_twice(spark, root):
    for _ in range(2):
        create_all(spark, root)
    assert all(read_table(spark, t, root).count() == 0 for t in TABLES.values())


def test_conform_fills_defaults(spark):
    row = conform(spark.createDataFrame([("o", None)], "order_id STRING, order_status STRING"), TABLES["silver.orders"]).first()
    assert row.order_status == "placed" and row.is_valid is True and row.processed_at is not None
    assert row.quantity is None


def test_first_and_last_per_key_with_hot_and_null_keys(spark):
    rows = [("hot", i, f"r{i}") for i in range(500)] + [(None, 2, "n2"), (None, 1, "n1"), ("x", None, "null"), ("x", 5, "five")]
    df = spark.createDataFrame(rows, "k STRING, o INT, v STRING").repartition(7)
    assert {r.k: r.v for r in first_per_key(df, ["k"], ["o"]).collect()} == {"hot": "r0", None: "n1", "x": "null"}
    assert {r.k: r.v for r in last_per_key(df, ["k"], ["o"]).collect()} == {"hot": "r499", None: "n2", "x": "five"}


def test_encode_events(spark):
    rows = spark.createDataFrame([("e1", "payment_failed", None), ("e2", "order_placed", "u")], "event_id STRING, event_type STRING, user_id STRING")
    got = {(r.topic, r.key, r.value) for r in encode_events(rows).collect()}
    assert got == {
        ("ecom.payments", "unknown", '{"event_id":"e1","event_type":"payment_failed"}'),
        ("ecom.orders", "u", '{"event_id":"e2","event_type":"order_placed","user_id":"u"}'),
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_writes_agree_with_a_dictionary(spark, tmp_path, seed):
    rng = random.Random(seed)
    root = f"file://{tmp_path}/tables"
    kept, replaced = {}, {}
    for step in range(3):
        rows = []
        for i in range(30):
            hour, category = rng.randrange(60), rng.choice(["A", "B", None])
            rows.append((f"2024-01-0{1 + hour // 24} {hour % 24:02d}:00", category, str(rng.randrange(1, 1000)), step * 100 + i))
        df = hours(spark, rows).repartition(rng.randrange(1, 5))
        insert_ignore(df, HOURLY_REVENUE, root + "/ignore", ["order_count"])
        upsert(df, HOURLY_REVENUE, root + "/upsert", ["order_count"])
        for hour, category, amount, _ in rows:
            key = (hour + ":00", category or "-")
            kept.setdefault(key, float(amount))
            replaced[key] = float(amount)
    assert content(spark, root + "/ignore") == sorted((*k, v) for k, v in kept.items())
    assert content(spark, root + "/upsert") == sorted((*k, v) for k, v in replaced.items())
