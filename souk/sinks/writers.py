"""Keyed writers on partitioned Parquet.

A write is spread with the REBALANCE hint: adaptive execution splits a hot partition over
several tasks and merges small ones, so files come out evenly sized however uneven the days are.

One writer per table at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import ExitStack, contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.grouping import first_per_key, last_per_key
from souk.sinks.key_filters import KeyFilters
from souk.sinks.key_index import KeyIndex
from souk.sources.schemas import EVENT_TOPIC, REJECTED, Table, TimePartition
from souk.sources.tables import (
    conform,
    create_if_absent,
    drop_partitions,
    read_partitions,
    read_table,
    stored_partitions,
)
from souk.sources.versions import Versions

# new rows are read two or three times per write; on disk they take no memory from the joins,
# however many they are, and a lost executor's part is computed again
REUSE = StorageLevel.DISK_ONLY
# keys that may be broadcast: as a hash table, in the driver and in each executor, a key takes some 150 bytes,
# ten times what it takes in a file
BROADCAST_KEYS = 100_000


@contextmanager
def storing() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function that stores rows until the block ends; those stored last go first."""
    with ExitStack() as stored:

        def keep(df: DataFrame) -> DataFrame:
            if not df.is_cached:
                stored.callback(df.persist(REUSE).unpersist)
            return df

        yield keep


def append(df: DataFrame, table: Table, root: str) -> None:
    """Add rows, without a count or emptiness test first."""
    rows = conform(df, table)
    if not _with_lookups(df, table, root):
        return _write(rows, table, root, mode="append")
    rows = rows.persist(REUSE)
    try:
        _add_fresh(rows, table, root)
    finally:
        rows.unpersist()


def insert_ignore(
    df: DataFrame,
    table: Table,
    root: str,
    order_by: Sequence[str] = (),
    everywhere: bool | None = None,
    spread: int | None = None,
    unique: bool = False,
) -> None:
    """Add the rows whose key is not in the table yet; the first of several new rows wins.

    ``everywhere`` decides whether known keys are searched in all partitions or only in those the
    new rows fall into; by default the latter if the key holds the partition value. Of all partitions,
    those are read whose filter may hold one of the keys (:class:`KeyFilters`). ``spread``: see
    :func:`_write`. ``unique``: ``df`` has one row per key already.
    """
    spark = df.sparkSession
    create_if_absent(spark, table, root)
    firsts = df if unique else first_per_key(df, table.keys, order_by)
    search_all = not table.key_fixes_partition if everywhere is None else everywhere
    with storing() as keep:
        rows = keep(conform(firsts, table))
        ids = keep(rows.select(*table.keys))  # looked up several times: the rows are much wider
        if table.partition is None:
            current = read_table(spark, table, root)
        elif search_all:
            current = KeyFilters(spark, table, root).known(ids)
        else:
            current = read_partitions(spark, table, root, _touched(rows, table))
        fresh = fresh_rows(rows, ids, current, table.keys, keep)
        if table.partition is None or table.key_fixes_partition:
            _write(fresh, table, root, mode="append", spread=spread)
        else:
            _add_fresh(keep(fresh), table, root, spread, filters=search_all)


def insert_indexed(
    df: DataFrame, table: Table, root: str, order_by: Sequence[str] = (), may_repeat: bool = True
) -> None:
    """:func:`insert_ignore` with the ids looked up in the table's :class:`KeyIndex`, which is started if
    there is none.

    The rows are written first, then their ids: if the job ends in between, the ids are missing. A batch
    that may be repeated (the first one after a start) is therefore compared with its own partitions too.
    """
    spark = df.sparkSession
    create_if_absent(spark, table, root)
    index = KeyIndex(spark, table, root)
    with storing() as keep:
        rows = keep(conform(first_per_key(df, table.keys, order_by), table))
        ids = keep(rows.select(*table.keys))
        held = index.held(ids)
        new = rows if held is None else keep(fresh_rows(rows, ids, held, table.keys, keep))
        fresh = new
        if may_repeat:
            own = read_partitions(spark, table, root, _touched(new, table))
            fresh = keep(fresh_rows(new, keep(new.select(*table.keys)), own, table.keys, keep))
        if KeyFilters(spark, table, root).runs:
            KeyFilters(spark, table, root).add(fresh)
        _write(fresh, table, root, mode="append")
        index.add(new)


def _with_lookups(df: DataFrame, table: Table, root: str) -> bool:
    """Whether the table has filters or an index to be kept."""
    if table.partition is None or table.key_fixes_partition or not table.keys:
        return False
    names = Versions(df.sparkSession, root).names()
    return "_filters" in names or "_ids" in names


def _add_fresh(fresh: DataFrame, table: Table, root: str, spread: int | None = None, filters: bool = False) -> None:
    """Write rows whose keys are new; filters learn of them before, the index after."""
    spark = fresh.sparkSession
    known = KeyFilters(spark, table, root)
    if filters or known.runs:
        known.add(fresh)
    _write(fresh, table, root, mode="append", spread=spread)
    if Versions(spark, f"{root}/_ids/{table.name.replace('.', '/')}").numbers():
        KeyIndex(spark, table, root).add(fresh)


def fresh_rows(
    rows: DataFrame,
    ids: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    keep: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The rows whose key (NULLs equal) does not occur in ``current``; ``ids`` are their stored keys.

    The keys are first looked up in ``current``: the small side is the new rows, so a large
    table is scanned for its key columns only and not shuffled when the new keys can be
    broadcast. Both sides that may be broadcast are stored (``keep``) and counted: Spark would go by
    estimates of rows not computed yet and by compressed files, and broadcast millions of keys.
    """
    many = ids.count() > BROADCAST_KEYS
    known = keep(_keyed_join(current.select(*keys), ids, keys, "left_semi", shuffled=many))
    count = known.count()
    if not count:
        return rows
    return _keyed_join(rows, known, keys, "left_anti", shuffled=count > BROADCAST_KEYS)


def merged_rows(updates: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``current`` with the rows of ``updates`` replaced or added (NULL key parts equal)."""
    kept = _keyed_join(current, updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates)


def upsert(
    df: DataFrame, table: Table, root: str, order_by: Sequence[str] = (), spread: int | None = None
) -> None:
    """Replace or add rows by key. Only the partitions that hold an updated key are rewritten.

    Spark writes the new partitions to a staging folder and swaps them in when the job commits, so
    reading the table that is being written is safe. Several updates of one key: the last by
    ``order_by`` wins.
    """
    if table.partition is None or not table.key_fixes_partition:
        raise ValueError(f"{table.name}: upsert needs a partition column that follows from the key")
    spark = df.sparkSession
    create_if_absent(spark, table, root)
    updates = conform(last_per_key(df, table.keys, order_by), table).persist(REUSE)
    try:
        current = read_partitions(spark, table, root, _touched(updates, table))
        merged = merged_rows(updates, current, table.keys).select(*table.schema.names)
        _write(merged, table, root, mode="overwrite", spread=spread)
    finally:
        updates.unpersist()


def replace_range(df: DataFrame, table: Table, root: str, since: Column | None = None) -> None:
    """Replace all rows whose partition time is not before ``since`` (None: all rows) by ``df``.

    For refreshes that recompute a whole range: groups that no longer exist go, which an upsert would
    keep. Rows before ``since`` in its partition are carried over. New partitions are staged
    until the job commits, so a failed job leaves the old rows; partitions without rows any more are
    removed after that.
    """
    spark = df.sparkSession
    create_if_absent(spark, table, root)
    rows = conform(last_per_key(df, table.keys), table)
    if since is not None:
        time = F.col(table.partition.column)
        since = since.cast(table.schema[table.partition.column].dataType)
        rows = rows.filter(time >= since)
        older = read_table(spark, table, root, since=since).filter(time < since)
        rows = rows.unionByName(older)
    rows = rows.select(*table.schema.names).persist(REUSE)
    try:
        stale = set(stored_partitions(spark, table, root, since)) - set(_touched(rows, table))
        _write(rows, table, root, mode="overwrite")
        drop_partitions(spark, table, root, sorted(stale, key=str))
    finally:
        rows.unpersist()


def write_rejected(
    df: DataFrame,
    root: str,
    *,
    topic: str | Column,
    record: Column,
    reason: str = "rejection_reason",
    spread: int | None = None,
) -> None:
    """Keep refused records with their topic, text and reason; needs the message position in
    ``partition`` and ``offset``, which makes a repeated write harmless."""
    rows = df.select(
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        record.alias("record_data"),
        F.col(reason).alias("rejection_reason"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )
    insert_ignore(rows, REJECTED, root, spread=spread)


def encode_events(events: DataFrame) -> DataFrame:
    """Events as messages: topic by event type, key = user, value = JSON of all fields."""
    topic_of = F.create_map(*[F.lit(x) for pair in EVENT_TOPIC.items() for x in pair])
    return events.select(
        F.try_element_at(topic_of, F.col("event_type")).alias("topic"),
        F.coalesce(F.col("user_id").cast("string"), F.lit("unknown")).alias("key"),
        F.to_json(F.struct(*events.columns)).alias("value"),
    )


KAFKA_SINK = {"kafka.acks": "all", "kafka.compression.type": "gzip", "kafka.retries": "3"}


def kafka_writer(messages: DataFrame, servers: str, checkpoint: str | None = None):
    """A configured Kafka writer for ``topic, key, value``: call ``.save()`` on a batch and
    ``.start()`` on a stream. Needs the Kafka connector on the classpath."""
    if messages.isStreaming:
        if not checkpoint:
            raise ValueError("a stream needs a checkpoint folder")
        writer = messages.writeStream.format("kafka").option("checkpointLocation", checkpoint)
    else:
        writer = messages.write.format("kafka")
    for key, value in {"kafka.bootstrap.servers": servers, **KAFKA_SINK}.items():
        writer = writer.option(key, value)
    return writer


def jdbc_writer(
    df: DataFrame,
    *,
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str = "org.postgresql.Driver",
    connections: int = 16,
    batch_size: int = 10_000,
):
    """A configured JDBC append; call ``.save()``. ``connections`` bounds the parallel writers."""
    return (
        df.write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("user", user)
        .option("password", password)
        .option("driver", driver)
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
    )


def _write(
    df: DataFrame, table: Table, root: str, mode: str, spread: int | None = None, below: str = ""
) -> None:
    """``below`` names a folder inside the table's. Without ``spread`` adaptive execution evens out the files. It does not run in the batches of a
    stateful stream: there ``spread`` deals each partition's rows over so many tasks."""
    part = table.partition
    if part is None:
        df.hint("rebalance").write.mode(mode).parquet(table.path(root))
        return
    extra = []
    if isinstance(part, TimePartition):
        # keep days together and rows in time order: readers skip row groups by their time range
        df = df.withColumn("_day", F.to_date(part.column))
        extra = ["_day"]
    if spread:
        salt = F.pmod(F.xxhash64(*table.keys), F.lit(spread))
        df = df.repartition(part.name, *extra, salt)
    else:
        df = df.hint("rebalance", part.name, *extra)
    if extra:
        df = df.sortWithinPartitions(part.name, part.column).drop("_day")
    writer = df.write.partitionBy(part.name).option("partitionOverwriteMode", "dynamic")
    writer.mode(mode).parquet(table.path(root) + below)


def _touched(rows: DataFrame, table: Table) -> list:
    """The partitions ``rows`` fall into: one value per partition the write touches anyway."""
    return [r[0] for r in rows.select(table.partition.name).distinct().collect()]


def _keyed_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, shuffled: bool = False
) -> DataFrame:
    """Semi or anti join on NULL-safe keys; ``shuffled``: the right side is never broadcast."""
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(other.hint("merge") if shuffled else other, on, how)
