"""Filters grow no faster than their keys, and large batches ask them little."""

from pyspark.sql import functions as F
from test_lookups import events

from souk.sinks import key_filters
from souk.sinks.key_filters import KeyFilters
from souk.sinks.writers import insert_ignore
from souk.sources import bindings as b
from souk.sources.schemas import RAW_EVENTS
from souk.sources.tables import read_table
from souk.streaming import event_tables


def parts(df):
    return {r[0] for r in df.select(F.spark_partition_id()).distinct().collect()}


def test_one_part_of_events_is_parsed_in_several(spark, root, monkeypatch):
    seen = []
    real = event_tables.bronze_events
    monkeypatch.setattr(event_tables, "bronze_events", lambda parsed: seen.append(parts(parsed)) or real(parsed))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        event_tables.write_batch(b.messages(b.table(spark, "/root/testdata/sf0.001", "events").coalesce(1)), root)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(seen[0]) > 1
    assert read_table(spark, RAW_EVENTS, root).count() == 1000


def test_filters_are_sized_by_the_largest_partition(spark, root, monkeypatch):
    """They were sized by all keys of the write in each partition: bits grew by keys times partitions."""
    monkeypatch.setattr(key_filters, "KEYS", 16)
    days = [f"2024-01-{d:02d} 10:00" for d in range(1, 17)]
    rows = events(spark, range(256), days[0]).withColumn(
        "event_time", F.expr("timestamp'2024-01-01 10:00:00' + make_dt_interval(cast(substring(event_id, 2) as int) % 16)")
    )
    insert_ignore(rows, RAW_EVENTS, root)
    filters = KeyFilters(spark, RAW_EVENTS, root)
    assert [r["segments"] for r in filters.runs] == [1]
    assert filters._read(filters.runs).count() == len(days)


def test_a_large_batch_names_the_same_partitions(spark, root, monkeypatch):
    """First by some keys, then by the others for the partitions that are left."""
    for d in range(1, 6):
        insert_ignore(events(spark, range(d * 100, d * 100 + 100), f"2024-01-{d:02d} 10:00"), RAW_EVENTS, root)
    filters = KeyFilters(spark, RAW_EVENTS, root)
    batch = events(spark, [*range(100, 200), 305, *range(9000, 9050)], "2024-02-01")
    whole = filters.partitions_of(batch)
    assert whole == ["2024-01-01", "2024-01-03"]
    asked = []
    real = KeyFilters._named
    monkeypatch.setattr(KeyFilters, "_named", lambda self, rows, of: asked.append((rows.count(), len(of))) or real(self, rows, of))
    monkeypatch.setattr(key_filters, "PROBES", 10)
    assert filters.partitions_of(batch) == whole
    (some, of), (others, left) = asked
    assert some + others == 151 and some < others and left < of
