"""Stateful streams: duplicates, hourly revenue, throughput."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from souk.functions.filters import not_cancelled
from souk.functions.money import ratio
from souk.sinks.writers import upsert
from souk.sources.schemas import HOURLY_REVENUE, Table
from souk.streaming.triggers import start

SPREAD = 16  # tasks that share one day's rows in a write of a stateful stream


def first_copies(
    rows: DataFrame,
    keys: Sequence[str],
    position: Sequence[str],
    event_time: str,
    delay: str,
    width: str = "1 hour",
) -> DataFrame:
    """The first row of each key, over all batches of a stream; of the copies in one batch, the one
    with the lowest ``position``. Start it in update mode (:func:`to_files` does).

    Copies of a row carry its event time: a key is unique within a window of ``width``. The state is
    the smallest (batch time, position, row) of each key and window, and is dropped once the watermark
    has passed the window; so are rows that arrive later than ``delay`` after their window's end. A group
    is passed on in the batch it first appears in, as only then its smallest batch time is the batch's own.
    """
    rest = [c for c in rows.columns if c not in keys and c not in position]
    # the batch's time is the same for all its rows, also when it is repeated
    dated = rows.withColumn("_arrived", F.current_timestamp()).withWatermark(event_time, delay)
    firsts = dated.groupBy(*keys, F.window(event_time, width).alias("_window")).agg(
        F.min(F.struct("_arrived", *position, *rest)).alias("_first")
    )
    new = firsts.where(F.col("_first._arrived") == F.current_timestamp())
    return new.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in rows.columns])


def deduplicated(
    events: DataFrame,
    key: str = "event_id",
    event_time: str = "event_time",
    delay: str = "1 hour",
    position: str | None = None,
) -> DataFrame:
    """One copy of each event, as long as copies lie within ``delay``, whatever times they carry.

    State is dropped behind the watermark, and so are rows that arrive later than ``delay``. Of copies
    that arrive together any one stays; ``position`` is carried along. :func:`first_copies` chooses the lowest.
    """
    if position is not None and position not in events.columns:
        raise ValueError(f"no column {position}")
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def hourly_revenue(orders: DataFrame, delay: str = "2 days") -> DataFrame:
    """Revenue per hour and category as a tumbling window; the state is one row per group."""
    live = not_cancelled(orders).withWatermark("event_time", delay)
    grouped = live.groupBy(F.window("event_time", "1 hour").alias("w"), "product_category").agg(
        F.sum("total_amount").alias("total_revenue"),
        F.count(F.lit(1)).alias("order_count"),
        F.count("total_amount").alias("_priced"),
    )
    return grouped.select(
        F.col("w.start").alias("hour_bucket"),
        "product_category",
        "total_revenue",
        "order_count",
        ratio(F.col("total_revenue"), F.col("_priced"), "decimal(12,2)").alias("avg_order_value"),
    )


def keep_table(
    updates: DataFrame, table: Table, root: str, checkpoint: str, trigger: str | None
) -> StreamingQuery:
    """Keep a keyed table up to date with a stream of changed groups."""
    writer = updates.writeStream.outputMode("update").foreachBatch(
        lambda batch, _: upsert(batch, table, root, spread=SPREAD)
    )
    return start(writer, checkpoint, trigger)


def run_hourly_revenue(
    orders: DataFrame, root: str, checkpoint: str, delay: str = "2 days", trigger: str | None = "1 minute"
) -> StreamingQuery:
    """Hourly revenue into its table while orders arrive; later corrections come from the batch
    refresh."""
    return keep_table(hourly_revenue(orders, delay), HOURLY_REVENUE, root, checkpoint, trigger)


def to_files(stream: DataFrame, path: str, checkpoint: str, trigger: str | None, mode: str = "update") -> StreamingQuery:
    """Add a stream's rows, or the groups that change, to Parquet files: a folder per batch, which a repeated
    batch replaces. Read them with the stream's own columns."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_number={number}")

    return start(stream.writeStream.outputMode(mode).foreachBatch(write), checkpoint, trigger)
