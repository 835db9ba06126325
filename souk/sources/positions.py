"""How far a consumer group has read each topic partition.

A group's positions are a small versioned file (one number per topic partition). A catch-up run reads from them
up to the ends it found when it began, handles these messages and commits the ends, so the next run goes on there; a run
that fails commits nothing. Partitions the group has not seen start at the ``earliest`` or ``latest`` message.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.sources.events import text_messages
from souk.sources.versions import Versions

EARLIEST, LATEST = -2, -1  # fixed: how Kafka's options write these
Positions = dict[str, dict[int, int]]  # topic -> partition -> offset of the next message


class ConsumerGroup:
    def __init__(self, spark: SparkSession, root: str, group: str, start: str = "earliest"):
        if start not in ("earliest", "latest"):
            raise ValueError(f"start at earliest or latest, not {start}")
        self.spark, self.start = spark, start
        self.versions = Versions(spark, f"{root}/_groups/{group}")

    def positions(self) -> Positions:
        _, content = self.versions.current()
        return {topic: {int(p): o for p, o in parts.items()} for topic, parts in content.items()}

    def commit(self, ends: Positions) -> None:
        """Move on to ``ends``; other partitions stay, and no position goes back."""
        number, _ = self.versions.current()
        merged = self.positions()
        for topic, parts in ends.items():
            held = merged.setdefault(topic, {})
            for partition, offset in parts.items():
                held[partition] = max(offset, held.get(partition, 0))
        self.versions.commit(number + 1, merged)
        if number > 2:
            self.versions.delete(f"_versions/{number - 2}.json")

    # --- Kafka ------------------------------------------------------------------------------------

    def starting_offsets(self, partitions: dict[str, list[int]]) -> str:
        """Kafka's ``startingOffsets`` for all partitions of the topics."""
        first, held = EARLIEST if self.start == "earliest" else LATEST, self.positions()
        return json.dumps({t: {str(p): held.get(t, {}).get(p, first) for p in parts} for t, parts in partitions.items()})

    def read_kafka(self, servers: str, partitions: dict[str, list[int]], ends: Positions) -> DataFrame:
        """The messages from the group's positions up to ``ends`` as a bounded read; needs the connector."""
        return text_messages(
            self.spark.read.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(partitions))
            .option("startingOffsets", self.starting_offsets(partitions))
            .option("endingOffsets", ending_offsets(ends))
            .load()
        )

    # --- bounded messages -------------------------------------------------------------------------

    def unread(self, messages: DataFrame, ends: Positions) -> DataFrame:
        """The messages between the group's positions and ``ends``."""
        held = self.positions()
        rows = [
            (topic, partition, held.get(topic, {}).get(partition, 0 if self.start == "earliest" else end), end)
            for topic, parts in ends.items()
            for partition, end in parts.items()
        ]
        ranges = self.spark.createDataFrame(rows, "topic STRING, partition INT, _from LONG, _to LONG")  # one row per topic partition
        inside = (F.col("offset") >= F.col("_from")) & (F.col("offset") < F.col("_to"))
        return messages.join(ranges, ["topic", "partition"]).where(inside).select(*messages.columns)

    def catch_up(self, messages: DataFrame, handle: Callable[[DataFrame], None]) -> Positions:
        """Handle all unread messages once, then move on; returns the new ends."""
        ends = ends_of(messages)
        handle(self.unread(messages, ends))
        self.commit(ends)
        return ends


def ending_offsets(ends: Positions) -> str:
    return json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in ends.items()})


def ends_of(messages: DataFrame) -> Positions:
    """The offset after the last message of each topic partition."""
    out: Positions = {}
    last = messages.groupBy("topic", "partition").agg(F.max("offset").alias("last"))
    for row in last.collect():  # one row per topic partition
        out.setdefault(row["topic"], {})[row["partition"]] = row["last"] + 1
    return out
