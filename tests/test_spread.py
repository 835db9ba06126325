"""Batches that come in few parts are worked on in many."""

from functools import partial

import pytest
from pyspark.sql import functions as F

from souk.sinks.writers import insert_ignore, insert_indexed
from souk.sources import bindings as b
from souk.sources.schemas import FLAT_ORDERS, ORDERS_TOPIC, REJECTED
from souk.sources.tables import read_table
from souk.streaming import flat_tables


def flat_orders(spark, n):
    return b.flat_order_messages(b.table(spark, "/root/testdata/sf0.01", "orders").limit(n).coalesce(1))


def parts(df):
    return {r[0] for r in df.select(F.spark_partition_id()).distinct().collect()}


def test_replayed_batches_have_files_for_all_cores(spark, tmp_path, monkeypatch):
    """A table of one part was replayed as one file per batch, which one task reads."""
    monkeypatch.setattr(b, "FILE_ROWS", 100, raising=False)
    lines = b.table(spark, "/root/testdata/sf0.001", "orders").coalesce(1)
    lines.write.parquet(f"{tmp_path}/orders.parquet")
    stream = b.replay(spark, str(tmp_path), "orders", "o_orderdate", again=True)
    query = stream.select("position", "copy").writeStream.foreachBatch(
        lambda rows, n: rows.withColumn("part", F.spark_partition_id()).write.parquet(f"{tmp_path}/seen/batch={n}")
    ).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    seen = spark.read.parquet(f"{tmp_path}/seen")
    n = lines.count()
    assert seen.select("position", "copy").distinct().count() == seen.count() == 2 * n
    batches = seen.groupBy("batch").agg(F.count_distinct("part").alias("parts")).collect()
    assert len(batches) == b.BATCHES + 1 and all(r["parts"] > 1 for r in batches)
    first = seen.groupBy("position").pivot("copy", [0, 1]).agg(F.max("batch"))
    assert first.where("`1` != `0` + 1").count() == 0


def test_one_part_of_messages_is_checked_in_several(spark, root, monkeypatch):
    monkeypatch.setattr(flat_tables, "write_checked", lambda checked, *_: seen.append(parts(checked)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        seen = []
        flat_tables.write_batch(flat_orders(spark, 2000), ORDERS_TOPIC, root)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(seen[0]) > 1


@pytest.mark.parametrize("insert", [insert_ignore, partial(insert_indexed, may_repeat=True)])
def test_checked_rows_are_stored_before_both_writes(spark, root, insert):
    """Two jobs at once on rows that are not stored yet compute them twice."""
    stored = []

    def watched(good, *rest):
        infos = [i for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()]
        stored.extend(i.numCachedPartitions() == i.numPartitions() for i in infos)
        insert(good, *rest)

    flat_tables.write_checked(flat_tables.checked_rows(flat_orders(spark, 500), ORDERS_TOPIC), ORDERS_TOPIC, root, watched)
    assert stored and all(stored)
    written = [read_table(spark, t, root).count() for t in (FLAT_ORDERS, REJECTED)]
    assert all(written) and sum(written) == 500
