"""Event messages into raw, silver and refused tables, batch by batch."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from souk.operators.medallion import (
    Silver,
    bronze_events,
    refused_events,
    silver_rows,
    silver_tables,
)
from souk.sinks.writers import REUSE, insert_ignore, write_rejected
from souk.sources.events import parse_events, spread
from souk.sources.schemas import RAW_EVENTS
from souk.streaming.triggers import start

TRIGGER = "10 seconds"


def write_batch(messages: DataFrame, root: str) -> None:
    """One batch of messages into all tables. Every write is keyed, so repeating a batch after a
    failure changes nothing."""
    parsed = parse_events(spread(messages)).persist(REUSE)  # parsed once for the five writes
    try:
        # raw events first: silver rows refer to them
        insert_ignore(bronze_events(parsed), RAW_EVENTS, root, unique=True)

        def write_silver(silver: Silver) -> None:
            insert_ignore(silver_rows(parsed, silver), silver.table, root, unique=True)

        def write_refused() -> None:
            refused = refused_events(parsed)
            write_rejected(refused, root, topic=F.col("topic"), record=F.col("value"))

        # the other tables are independent; side by side they fill the cluster better
        with ThreadPoolExecutor(4) as pool:
            writes = [pool.submit(write_silver, s) for s in silver_tables()]
            writes.append(pool.submit(write_refused))
        for write in writes:
            write.result()
    finally:
        parsed.unpersist()


def run(messages: DataFrame, root: str, checkpoint: str, trigger: str | None = TRIGGER) -> StreamingQuery:
    """Start the stream; ``trigger=None`` handles what is there and stops."""
    writer = messages.writeStream.foreachBatch(lambda batch, _: write_batch(batch, root))
    return start(writer, checkpoint, trigger)
