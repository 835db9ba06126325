"""Event messages: Kafka and file sources, JSON parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.sources.schemas import (
    CORRUPT,
    DELIVERIES_TOPIC,
    DELIVERY_EVENT,
    FLAT_BY_TOPIC,
    MESSAGE,
    ORDER_EVENT,
    ORDERS_TOPIC,
    PAYMENT_EVENT,
    PAYMENTS_TOPIC,
    TOPICS,
)

_JSON = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}


def read_kafka_stream(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str] = TOPICS,
    starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Subscribe to topics; needs the Kafka connector on the classpath. The stream's checkpoint
    takes the part of a consumer group."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return text_messages(reader.load())


def read_kafka_batch(
    spark: SparkSession, servers: str, topics: Sequence[str] = TOPICS, starting: str = "earliest"
) -> DataFrame:
    """The same messages as a bounded read."""
    return text_messages(
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .load()
    )


def read_message_files(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of files that hold messages with the Kafka columns."""
    reader = spark.readStream.schema(MESSAGE).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def text_messages(df: DataFrame) -> DataFrame:
    """Kafka's binary key and value as text."""
    return df.withColumns(
        {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    )


def spread(messages: DataFrame) -> DataFrame:
    """Messages dealt over all tasks by their position: a batch comes in as few parts as the topic has
    partitions or the source has files, and each part would be parsed by one task."""
    return messages.repartition("topic", "partition", "offset")


def parse_events(messages: DataFrame) -> DataFrame:
    """Adds the parsed struct of the message's own topic (``order``, ``payment``, ``delivery``)
    and the fields all events share; ``corrupt`` holds text that is not a readable event.

    A single field of the wrong type only becomes NULL.
    """
    parts = {
        "order": (ORDERS_TOPIC, ORDER_EVENT),
        "payment": (PAYMENTS_TOPIC, PAYMENT_EVENT),
        "delivery": (DELIVERIES_TOPIC, DELIVERY_EVENT),
    }
    structs = F.struct(
        *[
            F.when(F.col("topic") == topic, F.from_json("value", schema, _JSON)).alias(name)
            for name, (topic, schema) in parts.items()
        ]
    )
    # inline() keeps the parser in one place: as a plain column, filters on parsed fields would be
    # pushed below it and parse the text once more each
    parsed = messages.select("*", F.inline(F.array(structs)))

    def shared(field: str):
        return F.coalesce(*[F.col(f"{name}.{field}") for name in parts])

    return parsed.withColumns(
        {
            "event_id": shared("event_id"),
            "event_type": shared("event_type"),
            "event_time": F.try_to_timestamp(shared("timestamp")),
            "corrupt": F.when(shared("event_id").isNull(), shared(CORRUPT)),
        }
    )


def parse_flat(messages: DataFrame, topic: str) -> DataFrame:
    """The flat records of one topic plus ``corrupt`` and the message position."""
    record = F.from_json("value", FLAT_BY_TOPIC[topic], _JSON)
    return (
        messages.filter(F.col("topic") == topic)
        .select("value", "topic", "partition", "offset", F.inline(F.array(record)))
        .withColumnRenamed(CORRUPT, "corrupt")
    )
