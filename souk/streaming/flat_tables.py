"""Flat messages of one topic into its table, with or without validation."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from souk.operators.validate import (
    Rule,
    missing,
    rejected_rows,
    rules_for,
    unfit,
    unreadable,
    valid_rows,
    with_reason,
)
from souk.sinks.writers import REUSE, insert_ignore, insert_indexed, write_rejected
from souk.sources.events import parse_flat, spread
from souk.sources.schemas import FLAT_TABLES, Table
from souk.streaming.triggers import start

POSITION = ("partition", "offset")


def typed(records: DataFrame, table: Table) -> DataFrame:
    """Text fields in the table's types; what cannot be converted becomes NULL."""
    types = {f.name: f.dataType.simpleString() for f in table.schema.fields if f.name in records.columns}

    def convert(name: str, dtype: str):
        if dtype == "timestamp":
            return F.try_to_timestamp(F.col(name))
        if dtype == "int":  # "1.9" counts as 1, like a number in the message
            return F.col(name).try_cast("double").try_cast("int")
        return F.col(name).try_cast(dtype)

    return records.select(
        *[convert(n, t).alias(n) for n, t in types.items()], *POSITION
    )


def storage_rules(table: Table, columns: list[str]) -> list[Rule]:
    """Values the table's types cannot take; empty text counts as absent."""
    types = {f.name: f.dataType.simpleString() for f in table.schema.fields if f.name in columns}
    typed_columns = {n: t for n, t in types.items() if t != "string"}
    return [unfit(n, t, F.when(F.col(n) != "", F.col(n))) for n, t in typed_columns.items()]


def checked_rows(messages: DataFrame, topic: str, validate: bool = True) -> DataFrame:
    """The records of a topic (batch or stream) with the reason to refuse them."""
    records, table = parse_flat(messages, topic), FLAT_TABLES[topic]
    rules = [unreadable(), *(rules_for(topic) if validate else map(missing, table.keys))]
    return with_reason(records, [*rules, *storage_rules(table, records.columns)])


def write_checked(checked: DataFrame, topic: str, root: str, insert: Callable = insert_ignore) -> None:
    """Insert the good records (first of a key wins) and keep the refused ones with a reason."""
    table = FLAT_TABLES[topic]
    checked = checked.persist(REUSE)
    try:
        checked.count()  # two jobs that start on rows not stored yet would both parse them
        good = typed(valid_rows(checked), table)
        # the two tables are independent; side by side they fill the cluster better
        with ThreadPoolExecutor(2) as pool:
            writes = [
                pool.submit(insert, good, table, root, POSITION),
                pool.submit(write_rejected, rejected_rows(checked), root, topic=topic, record=F.col("value")),
            ]
        for write in writes:
            write.result()
    finally:
        checked.unpersist()


def write_batch(messages: DataFrame, topic: str, root: str, validate: bool = True) -> None:
    """One bounded set of messages; known ids are searched in the whole table.

    Without ``validate`` only unreadable text, records without a key and values that the table
    cannot hold are refused.
    """
    write_checked(checked_rows(spread(messages), topic, validate), topic, root)


def run(
    messages: DataFrame,
    topic: str,
    root: str,
    checkpoint: str,
    validate: bool = True,
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    """Start the stream of one topic; ``trigger=None`` handles what is there and stops.

    Ids seen before are looked up in the table's id index, in the hash buckets of the batch's own
    ids; the stream itself keeps no state. Only the first batch after a start can repeat one that was
    written before.
    """
    started: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        write_checked(
            checked_rows(spread(batch), topic, validate), topic, root, partial(insert_indexed, may_repeat=not started)
        )
        started.append(number)

    return start(messages.writeStream.foreachBatch(write), checkpoint, trigger)
