"""Known ids: the index in hash buckets, the filters per partition, and streams that use them."""

import json
import random

import pytest
from pyspark.sql import functions as F
from test_streaming import messages

from souk.sinks import key_filters, key_index, writers
from souk.sinks.key_filters import KeyFilters
from souk.sinks.key_index import KeyIndex
from souk.sinks.writers import append, insert_ignore, insert_indexed
from souk.sources import bindings as b
from souk.sources.events import read_message_files
from souk.sources.schemas import FLAT_ORDERS, MESSAGE, ORDERS_TOPIC, RAW_EVENTS, REJECTED
from souk.sources.tables import read_table
from souk.sources.versions import Versions
from souk.streaming import event_tables, flat_tables, windows

FIELDS = [c.split()[0] for c in MESSAGE.split(", ")]


def events(spark, ids, day):
    rows = [(f"e{i}", "order_placed", "{}") for i in ids]
    df = spark.createDataFrame(rows, "event_id STRING, event_type STRING, raw_payload STRING")
    return df.withColumn("event_time", F.lit(day).cast("timestamp"))


def flat(spark, ids, day, amount=1):
    rows = [(i, str(amount), k) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "order_id STRING, total_amount STRING, offset LONG")
    return df.withColumn("timestamp", F.lit(day).cast("timestamp"))


def test_versions_are_taken_once(spark, tmp_path):
    first, second = (Versions(spark, f"file://{tmp_path}/t") for _ in range(2))
    assert first.current() == (0, {})
    first.commit(1, {"runs": ["é"]})
    assert second.current() == (1, {"runs": ["é"]})
    with pytest.raises(RuntimeError, match="taken"):
        second.commit(1, {"runs": []})
    second.commit(2, {})
    assert first.current() == (2, {}) and first.numbers() == [1, 2]


def test_filters_name_the_partitions_to_read(spark, root):
    """New keys read nothing, keys that came before only their own day."""
    days = [f"2024-01-{d:02d} 10:00" for d in range(1, 9)]
    for n, day in enumerate(days):
        insert_ignore(events(spark, range(n * 300, n * 300 + 300), day), RAW_EVENTS, root)
    filters = KeyFilters(spark, RAW_EVENTS, root)
    new = events(spark, range(100_000, 100_300), "2024-01-09")
    assert filters.known(new).inputFiles() == [] and filters.uncovered() == []
    again = events(spark, [5, 7, 650], "2024-01-09")  # of the first and the third day, redelivered with another time
    read = filters.known(again).inputFiles()
    assert {f.split("event_date=")[1][:10] for f in read} == {"2024-01-01", "2024-01-03"}
    before = read_table(spark, RAW_EVENTS, root).count()
    insert_ignore(again.unionByName(new), RAW_EVENTS, root)
    assert read_table(spark, RAW_EVENTS, root).count() == before + 300


def test_no_stored_key_is_missed(spark, root, monkeypatch):
    """Through many writes, merges of filters, hot days and rows written without filters."""
    monkeypatch.setattr(key_filters, "FAN", 3)
    monkeypatch.setattr(key_filters, "KEYS", 16)  # several sizes of filters
    rng, stored = random.Random(5), {}
    for step in range(9):
        day = f"2024-01-{rng.choice([1, 1, 2, 3]):02d} 12:00"
        ids = [rng.randrange(800) for _ in range(rng.choice([5, 40, 200]))]
        if step == 4:  # a partition that other code filled
            append_only = events(spark, ["x1", "x2"], "2024-01-20")
            from souk.sources.tables import conform

            conform(append_only, RAW_EVENTS).write.mode("append").partitionBy("event_date").parquet(RAW_EVENTS.path(root))
            stored |= {"ex1": "2024-01-20", "ex2": "2024-01-20"}
            ids += ["x1"]
        insert_ignore(events(spark, ids, day), RAW_EVENTS, root)
        for i in ids:
            stored.setdefault(f"e{i}", day[:10])
        kept = {r.event_id: str(r.event_date) for r in read_table(spark, RAW_EVENTS, root).collect()}
        assert kept == stored
        assert read_table(spark, RAW_EVENTS, root).count() == len(stored)
    runs = KeyFilters(spark, RAW_EVENTS, root).runs
    assert len(runs) < 9 and any(r["level"] for r in runs)


def test_index_keeps_the_first_across_runs_and_merges(spark, root, monkeypatch):
    monkeypatch.setattr(key_index, "FAN", 3)
    rng, stored = random.Random(6), {}
    for step in range(11):
        day = f"2024-{rng.randrange(1, 5):02d}-05"
        ids = [None if rng.random() < 0.02 else f"o{rng.randrange(300)}" for _ in range(60)]
        insert_indexed(flat(spark, ids, day, step + 1), FLAT_ORDERS, root, ["offset"], may_repeat=step % 4 == 0)
        for i in ids:
            stored.setdefault(i, step + 1)
    kept = [(r.order_id, int(r.total_amount)) for r in read_table(spark, FLAT_ORDERS, root).collect()]
    assert sorted(kept, key=str) == sorted(stored.items(), key=str)
    index = KeyIndex(spark, FLAT_ORDERS, root)
    assert max(level for _, level in index.runs) == 2 and len(index.runs) < 6
    merged = [name for name, level in index.runs if level][0]
    few = index.held(flat(spark, ["o1"], "2024-01-01")).inputFiles()  # one bucket of each merged run
    assert len([f for f in few if merged in f]) <= 1 < len(index.versions.names(merged)) - 1


def test_index_starts_from_a_filled_table_and_follows_other_writers(spark, root):
    append(flat(spark, ["a"], "2024-01-01", 1), FLAT_ORDERS, root)
    insert_indexed(flat(spark, ["a", "b"], "2024-02-01", 2), FLAT_ORDERS, root)
    insert_ignore(flat(spark, ["b", "c"], "2024-03-01", 3), FLAT_ORDERS, root)  # searches with filters
    append(flat(spark, ["d"], "2024-03-02", 4), FLAT_ORDERS, root)
    insert_indexed(flat(spark, ["a", "b", "c", "d", "e"], "2024-04-01", 5), FLAT_ORDERS, root, may_repeat=False)
    insert_ignore(flat(spark, ["e", "d", "f"], "2024-05-01", 6), FLAT_ORDERS, root)
    kept = {r.order_id: int(r.total_amount) for r in read_table(spark, FLAT_ORDERS, root).collect()}
    assert kept == {"a": 1, "b": 2, "c": 3, "d": 4, "e": 5, "f": 6}


def test_batch_that_failed_between_rows_and_ids(spark, root, monkeypatch):
    insert_indexed(flat(spark, ["a"], "2024-01-01"), FLAT_ORDERS, root)
    monkeypatch.setattr(KeyIndex, "add", lambda self, rows: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        insert_indexed(flat(spark, ["b"], "2024-01-02"), FLAT_ORDERS, root, may_repeat=False)
    monkeypatch.undo()
    insert_indexed(flat(spark, ["b", "c"], "2024-01-02", 2), FLAT_ORDERS, root, may_repeat=True)  # the batch again
    insert_indexed(flat(spark, ["b"], "2024-05-01", 3), FLAT_ORDERS, root, may_repeat=False)
    assert sorted((r.order_id, int(r.total_amount)) for r in read_table(spark, FLAT_ORDERS, root).collect()) == [("a", 1), ("b", 1), ("c", 2)]


def order(i, amount, day):
    return {"order_id": i, "customer_id": "c", "product_name": "p", "price": 2, "quantity": 2, "status": "placed", "total_amount": amount, "timestamp": day}


@pytest.mark.parametrize("files", [1, 3])
def test_flat_stream_for_any_batch_borders_and_a_restart(spark, tmp_path, files):
    rng = random.Random(7)
    rows = [order(f"o{rng.randrange(40)}", k + 1, f"2024-0{rng.randrange(1, 4)}-01T00:00:00") for k in range(120)]
    rows[17]["status"] = "lost"
    texts = [(ORDERS_TOPIC, json.dumps(r)) for r in rows]
    first = {}
    for k, r in enumerate(rows):
        if k != 17:
            first.setdefault(r["order_id"], k + 1)
    source, root = f"{tmp_path}/source", f"file://{tmp_path}/tables"
    whole = messages(spark, texts).select(*FIELDS)
    for k in range(files):  # one batch each, in this order
        whole.where(f"offset < 80 and floor(offset * {files} / 80) = {k}").coalesce(1).write.mode("append").parquet(source)
    for more in (80, 200):  # the second start finds new files and the same ids
        stream = read_message_files(spark, source, max_files_per_trigger=1)
        query = flat_tables.run(stream, ORDERS_TOPIC, root, f"{root}/checkpoint", trigger=None)
        query.awaitTermination()
        if more == 80:
            whole.where("offset >= 80").coalesce(1).write.mode("append").parquet(source)
    kept = {r.order_id: int(r.total_amount) for r in read_table(spark, FLAT_ORDERS, root).collect()}
    assert kept == first
    assert read_table(spark, REJECTED, root).count() == 1


def test_first_copies_across_batches(spark, tmp_path):
    """The lowest position of the first batch stays; late rows and later copies go; nothing runs in Python."""
    folder = f"{tmp_path}/events"
    at = lambda hour: f"2024-01-01 {hour:02d}:30:00"
    batches = [
        [(1, at(1), 5, "b"), (1, at(1), 4, "a"), (None, at(1), 3, "n"), (2, at(2), 9, "c")],
        [(1, at(1), 1, "lower but later"), (2, at(2), 10, "again"), (3, at(20), 11, "d")],
        [(5, at(21), 13, "e"), (3, at(20), 2, "again")],
        [(4, at(3), 12, "late"), (5, at(21), 14, "again")],  # the watermark counts one batch later
    ]
    for rows in batches:
        df = spark.createDataFrame(rows, "event_id LONG, t STRING, offset LONG, note STRING")
        df.withColumn("event_time", F.col("t").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    rows = windows.first_copies(stream, ["event_id"], ["offset"], "event_time", "2 hours")
    query = windows.to_files(rows, f"{tmp_path}/out", f"{tmp_path}/cp", trigger=None)
    query.awaitTermination()
    assert "Python" not in rows._jdf.queryExecution().logical().toString()
    got = {(r.event_id, r.note) for r in spark.read.schema(rows.schema).parquet(f"{tmp_path}/out").collect()}
    assert got == {(1, "a"), (None, "n"), (2, "c"), (3, "d"), (5, "e")}


def test_event_stream_reads_only_the_days_of_known_keys(spark, root, monkeypatch):
    source = b.messages(b.table(spark, "/root/testdata/sf0.001", "events")).select(*FIELDS)
    event_tables.write_batch(source, root)
    count = read_table(spark, RAW_EVENTS, root).count()
    searched = []
    original = KeyFilters.partitions_of
    monkeypatch.setattr(KeyFilters, "partitions_of", lambda self, rows: searched.append((self.table.name, found := original(self, rows))) or found)
    day = F.to_date("timestamp") == F.lit("2024-01-03")
    event_tables.write_batch(source.where(day), root)
    assert read_table(spark, RAW_EVENTS, root).count() == count
    days = {d for name, found in searched for d in found if name == "bronze.raw_events"}
    assert "2024-01-03" in days and len(days) <= 2


@pytest.mark.parametrize("insert", ["insert_ignore", "insert_indexed"])
def test_many_keys_are_not_broadcast(spark, root, monkeypatch, insert):
    """The joins went by estimates of rows not computed yet and by compressed files: millions of keys met in the driver as
    one hash table."""
    many = 100_001

    def orders(ids):
        at = F.expr("timestamp'2024-01-01 10:00:00'").alias("timestamp")
        return ids.select(F.concat(F.lit("o"), "id").alias("order_id"), F.lit(1).alias("total_amount"), at)

    joins = []
    real = writers._keyed_join

    def watched(left, right, keys, how, **options):
        joined = real(left, right, keys, how, **options)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        join = next(line for line in plan.splitlines() if "Join" in line)
        joins.append((how, right.count() >= many, "BroadcastHashJoin" in join))
        return joined

    monkeypatch.setattr(writers, "_keyed_join", watched)
    stored = set(spark.sparkContext._jsc.getPersistentRDDs())
    insert_into = getattr(writers, insert)
    insert_into(orders(spark.range(many)), FLAT_ORDERS, root)
    insert_into(orders(spark.range(many + 1000)), FLAT_ORDERS, root)  # all known ones and 1000 new ones
    assert {how for how, large, _ in joins if large} == {"left_semi", "left_anti"}
    assert not any(large and broadcast for _, large, broadcast in joins), joins
    joins.clear()
    insert_into(orders(spark.range(many, many + 1500)), FLAT_ORDERS, root)
    assert ("left_anti", False, True) in joins  # a few known ones may be
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= stored
    ids = read_table(spark, FLAT_ORDERS, root).select("order_id")
    assert ids.count() == ids.distinct().count() == many + 1500
