"""Streams: replay in batches equals one batch, redelivery changes nothing, bad input is kept."""

import json

import pytest
from pyspark.sql import functions as F

from souk.sources import bindings as b
from souk.sources.events import read_message_files
from souk.sources.schemas import (
    DELIVERIES,
    FLAT_ORDERS,
    HOURLY_REVENUE,
    MESSAGE,
    ORDERS,
    ORDERS_TOPIC,
    PAYMENTS,
    PAYMENTS_TOPIC,
    RAW_EVENTS,
    REJECTED,
)
from souk.sources.tables import read_table
from souk.streaming import event_tables, flat_tables, windows

SF_DIR = "/root/testdata/sf0.001"
KEYED = (RAW_EVENTS, ORDERS, PAYMENTS, DELIVERIES, REJECTED)
CLOCK = ("processed_at", "ingested_at", "rejected_at")


def event(event_id, kind, **fields):
    base = {"event_id": event_id, "event_type": kind, "timestamp": "2024-01-01T10:00:00+00:00", "user_id": "u"}
    return json.dumps({**base, **fields})


def order(event_id, order_id, **fields):
    return event(event_id, "order_placed", order_id=order_id, **{"product_id": "p", "quantity": 1, "total_amount": 5.0, **fields})


def messages(spark, rows):
    full = [("k", value, topic, 0, i) for i, (topic, value) in enumerate(rows)]
    df = spark.createDataFrame(full, "key STRING, value STRING, topic STRING, partition INT, offset LONG")
    return df.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))


def tables(spark, root):
    return {t.name: sorted(str(r) for r in read_table(spark, t, root).drop(*CLOCK).collect()) for t in KEYED}


def test_replay_in_batches_and_duplicated_file(spark, tmp_path):
    source = b.messages(b.table(spark, SF_DIR, "events")).select(*[c.split()[0] for c in MESSAGE.split(", ")])
    one, many = f"file://{tmp_path}/one", f"file://{tmp_path}/many"
    event_tables.write_batch(source, one)
    parts = f"{tmp_path}/messages"
    source.repartition(3, "offset").write.parquet(parts)
    source.limit(400).coalesce(1).write.mode("append").parquet(parts)  # a file delivered again
    stream = read_message_files(spark, parts, max_files_per_trigger=1)
    run = event_tables.run(stream, many, f"{many}/checkpoint", trigger=None)
    run.awaitTermination()
    assert len(run.recentProgress) >= 4
    assert tables(spark, one) == tables(spark, many)
    event_tables.write_batch(source, one)  # the whole history once more
    assert tables(spark, one) == tables(spark, many)


def test_bad_events_are_kept_with_a_reason(spark, root):
    rows = [
        (ORDERS_TOPIC, order("e1", "o1")),
        (ORDERS_TOPIC, order("e1", "o1")),  # redelivered
        (ORDERS_TOPIC, order("e2", "o2", quantity=0)),
        (ORDERS_TOPIC, order("e3", "o3", timestamp="yesterday")),
        (ORDERS_TOPIC, order("e4", "o4", total_amount=0)),  # only kept raw
        (ORDERS_TOPIC, '{"event_id": "e5"'),
        (ORDERS_TOPIC, '{"event_type": "order_placed"}'),
        (PAYMENTS_TOPIC, event("e6", "payment_failed", payment_id="p1", amount=3.0)),
        (PAYMENTS_TOPIC, event("e7", "payment_failed", amount=3.0)),  # no key: only kept raw
        (ORDERS_TOPIC, event("e8", "order_cancelled", order_id="o1")),
    ]
    event_tables.write_batch(messages(spark, rows), root)
    assert {r.event_id for r in read_table(spark, RAW_EVENTS, root).collect()} == {"e1", "e2", "e3", "e4", "e6", "e7", "e8"}
    assert [r.order_id for r in read_table(spark, ORDERS, root).collect()] == ["o1"]
    assert [r.payment_id for r in read_table(spark, PAYMENTS, root).collect()] == ["p1"]
    refused = {r.kafka_offset: r.rejection_reason for r in read_table(spark, REJECTED, root).collect()}
    assert refused == {
        2: "quantity violates quantity > 0", 3: "event_time is null", 5: "Malformed JSON", 6: "event_id is null",
    }


@pytest.mark.parametrize("validate", [True, False])
def test_flat_orders(spark, root, validate):
    good = {"order_id": "a", "customer_id": "c", "product_name": "p", "price": 2, "total_amount": 4, "quantity": 2, "status": "placed", "timestamp": "2024-01-01T09:00:00"}
    rows = [good, {**good, "total_amount": 9}, {**good, "order_id": "b", "status": "lost"}, {**good, "order_id": ""}]
    texts = [(ORDERS_TOPIC, json.dumps(r)) for r in rows] + [(ORDERS_TOPIC, "nonsense"), (PAYMENTS_TOPIC, "{}")]
    for _ in range(2):  # a repeated batch changes nothing
        flat_tables.write_batch(messages(spark, texts), ORDERS_TOPIC, root, validate)
    kept = {r.order_id: float(r.total_amount) for r in read_table(spark, FLAT_ORDERS, root).collect()}
    refused = {r.kafka_offset: r.rejection_reason for r in read_table(spark, REJECTED, root).collect()}
    if validate:
        assert kept == {"a": 4.0}
        assert refused == {2: "Invalid status: lost", 3: "Missing order_id", 4: "Malformed JSON"}
    else:
        assert kept == {"a": 4.0, "b": 4.0}
        assert refused == {3: "Missing order_id", 4: "Malformed JSON"}


@pytest.mark.parametrize("field, value, reason", [
    ("total_amount", "12345678901.5", "Invalid total_amount — not a decimal(12,2)"),
    ("total_amount", "NaN", "Invalid total_amount — not a decimal(12,2)"),
    ("price", "Infinity", "Invalid price — not a decimal(12,2)"),
    ("timestamp", "yesterday", "Invalid timestamp — not a timestamp"),
])
def test_values_that_do_not_fit_are_refused(spark, root, field, value, reason):
    good = {"order_id": "a", "customer_id": "c", "product_name": "p", "price": 2, "total_amount": 4, "quantity": 2, "status": "placed", "timestamp": "2024-01-01T09:00:00"}
    texts = [(ORDERS_TOPIC, json.dumps({**good, field: value})), (ORDERS_TOPIC, json.dumps({**good, "order_id": "b"}))]
    flat_tables.write_batch(messages(spark, texts), ORDERS_TOPIC, root)
    assert [r.order_id for r in read_table(spark, FLAT_ORDERS, root).collect()] == ["b"]
    assert [r.rejection_reason for r in read_table(spark, REJECTED, root).collect()] == [reason]


def test_silver_takes_only_raw_events(spark, root):
    rows = [(ORDERS_TOPIC, order("e1", "o1")), (ORDERS_TOPIC, order("e2", "o2", total_amount=1e15))]
    rows += [(ORDERS_TOPIC, json.dumps({k: v for k, v in json.loads(order("e3", "o3")).items() if k != "event_id"}))]
    event_tables.write_batch(messages(spark, rows), root)
    assert [r.order_id for r in read_table(spark, ORDERS, root).collect()] == ["o1"]
    refused = {r.kafka_offset: r.rejection_reason for r in read_table(spark, REJECTED, root).collect()}
    assert refused == {1: "Invalid total_amount — not a decimal(12,2)", 2: "event_id is null"}


def test_interval_trigger(spark, tmp_path):
    source, root = f"{tmp_path}/source", f"file://{tmp_path}/tables"
    texts = [(ORDERS_TOPIC, order(f"e{i}", f"o{i}")) for i in range(5)]
    messages(spark, texts).select(*[c.split()[0] for c in MESSAGE.split(", ")]).write.parquet(source)
    run = event_tables.run(read_message_files(spark, source), root, f"{root}/checkpoint", trigger="1 second")
    try:
        run.processAllAvailable()
        assert read_table(spark, ORDERS, root).count() == 5
    finally:
        run.stop()


def test_flat_stream_keeps_the_first_of_all_batches(spark, tmp_path):
    source, root = f"{tmp_path}/source", f"file://{tmp_path}/tables"
    good = {"order_id": "a", "customer_id": "c", "product_name": "p", "price": 2, "quantity": 2, "status": "placed"}
    record = lambda amount, day: (ORDERS_TOPIC, json.dumps({**good, "total_amount": amount, "timestamp": day}))
    for texts in ([record(4, "2024-01-31T23:00:00"), record(9, "2024-01-01")], [record(5, "2024-03-01")], [(ORDERS_TOPIC, "x")]):
        batch = messages(spark, texts).select(*[c.split()[0] for c in MESSAGE.split(", ")])
        batch.coalesce(1).write.mode("append").parquet(source)
    stream = read_message_files(spark, source, max_files_per_trigger=1)
    flat_tables.run(stream, ORDERS_TOPIC, root, f"{root}/checkpoint", trigger=None).awaitTermination()
    assert [float(r.total_amount) for r in read_table(spark, FLAT_ORDERS, root).collect()] == [4.0]
    assert [r.rejection_reason for r in read_table(spark, REJECTED, root).collect()] == ["Malformed JSON"]


def event_files(spark, tmp_path, n):
    folder = f"{tmp_path}/events"
    events = b.table(spark, SF_DIR, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartitionByRange(n, "ts").write.parquet(folder)
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    return events, reader.parquet(folder)


def test_hourly_revenue_over_several_batches(spark, tmp_path):
    root = f"file://{tmp_path}/tables"
    events, stream = event_files(spark, tmp_path, 4)
    wanted = ("product_category", "order_status", "total_amount", "event_time")
    run = windows.run_hourly_revenue(b.event_orders_from(stream, *wanted), root, f"{root}/cp", "60 days", trigger=None)
    run.awaitTermination()
    got = read_table(spark, HOURLY_REVENUE, root).select("hour_bucket", "product_category", "total_revenue", "order_count")
    live = b.event_orders_from(events, *wanted).filter("order_status <> 'cancelled'")
    expected = live.groupBy(F.date_trunc("hour", "event_time"), "product_category").agg(F.sum("total_amount"), F.count("*"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


@pytest.mark.parametrize("position", [None, "offset"])
def test_dedupe_across_batches(spark, tmp_path, position):
    events, stream = event_files(spark, tmp_path, 3)
    rows = stream.select("event_id", F.col("ts").alias("event_time"), F.col("event_id").alias("offset"))
    hot = rows.withColumn("event_id", F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("event_id")))
    unique = windows.deduplicated(hot, delay="60 days", position=position).select("event_id")
    windows.to_files(unique, f"{tmp_path}/out", f"{tmp_path}/cp", trigger=None).awaitTermination()
    got = [r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    expected = events.select(F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("event_id")).alias("e")).distinct()
    assert sorted(got) == sorted(r.e for r in expected.collect())


def test_table_stream_reads_a_folder_of_files(spark, tmp_path):
    folder = f"{tmp_path}/sf"
    b.table(spark, SF_DIR, "events").repartition(3).write.parquet(f"{folder}/events.parquet")
    stream = b.event_stream(spark, folder, max_files=1).select("event_id")
    windows.to_files(stream, f"{tmp_path}/out", f"{tmp_path}/cp", trigger=None).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").distinct().count() == b.table(spark, SF_DIR, "events").count()
