"""Event messages to bronze and silver rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.functions.grouping import first_per_key, last_per_key, lookup_ids
from souk.operators.validate import (
    Rule,
    constraint_rules,
    rejected_rows,
    unfit,
    unreadable,
    valid_rows,
    with_reason,
)
from souk.sources.schemas import (
    DELIVERIES,
    DELIVERIES_TOPIC,
    DELIVERY_EVENT,
    EVENT_TOPIC,
    ORDER_EVENT,
    ORDERS,
    ORDERS_TOPIC,
    PAYMENT_EVENT,
    PAYMENTS,
    PAYMENTS_TOPIC,
    Table,
)

# fixed values
PLACED = "order_placed"
CANCELLED = "order_cancelled"
PAYMENT_TYPES = ("payment_success", "payment_failed")
DELIVERY_TYPES = ("order_shipped", "order_delivered")
POSITION = ("partition", "offset")
NEEDED = ("event_id", "event_type", "corrupt")  # what the raw table's rules look at


def routed(events: DataFrame) -> DataFrame:
    """Adds ``route``: the topic an event type belongs to, NULL for unknown types."""
    topic_of = F.create_map(*[F.lit(x) for pair in EVENT_TOPIC.items() for x in pair])
    return events.withColumn("route", F.try_element_at(topic_of, F.col("event_type")))


def bronze_rules() -> list[Rule]:
    """What keeps a message out of the raw table."""
    return [
        unreadable(),
        (F.col("event_id").isNull(), F.lit("event_id is null")),
        (F.col("event_type").isNull(), F.lit("event_type is null")),
    ]


def bronze_events(parsed: DataFrame) -> DataFrame:
    """Ids, raw text and position of each readable event; the first copy of an event stays."""
    rows = valid_rows(with_reason(parsed, bronze_rules())).select(
        "event_id",
        "event_type",
        F.col("value").alias("raw_payload"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        "event_time",
    )
    return first_per_key(rows, ["event_id"], ["kafka_partition", "kafka_offset"])


@dataclass(frozen=True)
class Silver:
    """How the events of one topic become rows of a silver table."""

    table: Table
    topic: str
    applies: Column  # which of the topic's events the table takes
    columns: dict[str, Column]
    amounts: dict[str, Column] = field(default_factory=dict)  # as given, before they are typed

    def rules(self) -> list[Rule]:
        """What keeps an event out of the table: it must be a raw event, fit and meet the
        constraints."""
        types = {f.name: f.dataType.simpleString() for f in self.table.schema.fields}
        fit = [unfit(name, types[name], F.col(f"_given_{name}")) for name in self.amounts]
        return [*bronze_rules(), *fit, *constraint_rules(self.table)]

    def typed(self) -> list[Column]:
        return [
            *[c.alias(n) for n, c in self.columns.items()],
            *[c.alias(f"_given_{n}") for n, c in self.amounts.items()],
        ]


def silver_orders() -> Silver:
    """Placed orders with a key and a positive amount, typed."""
    o = {c: F.col(f"order.{c}") for c in StructType.fromDDL(ORDER_EVENT).names}
    same = (
        "user_id", "session_id", "product_id", "product_category", "quantity", "payment_method", "city", "state",
        "device",
    )
    return Silver(
        ORDERS,
        ORDERS_TOPIC,
        (F.col("event_type") == PLACED) & o["order_id"].isNotNull() & (o["total_amount"] > 0),
        {
            "order_id": o["order_id"],
            "event_id": F.col("event_id"),
            **{c: o[c] for c in same},
            "unit_price": o["unit_price"].try_cast("decimal(10,2)"),
            "total_amount": o["total_amount"].try_cast("decimal(12,2)"),
            "order_status": F.lit("placed"),
            "event_time": F.col("event_time"),
            "is_valid": F.lit(True),
        },
        {c: o[c] for c in ("unit_price", "total_amount")},
    )


def silver_payments() -> Silver:
    """Payment results with a key, typed."""
    p = {c: F.col(f"payment.{c}") for c in StructType.fromDDL(PAYMENT_EVENT).names}
    same = ("payment_method", "payment_status", "failure_reason")
    return Silver(
        PAYMENTS,
        PAYMENTS_TOPIC,
        F.col("event_type").isin(*PAYMENT_TYPES) & p["payment_id"].isNotNull(),
        {
            **{c: p[c] for c in ("payment_id", "order_id", "user_id")},
            "amount": p["amount"].try_cast("decimal(12,2)"),
            **{c: p[c] for c in same},
            "event_time": F.col("event_time"),
        },
        {"amount": p["amount"]},
    )


def silver_deliveries() -> Silver:
    """Shipping and delivery events with a key, and whether they are late."""
    d = {c: F.col(f"delivery.{c}") for c in StructType.fromDDL(DELIVERY_EVENT).names}
    same = ("delivery_status", "city", "estimated_days", "actual_days")
    return Silver(
        DELIVERIES,
        DELIVERIES_TOPIC,
        F.col("event_type").isin(*DELIVERY_TYPES) & d["delivery_id"].isNotNull(),
        {
            **{c: d[c] for c in ("delivery_id", "order_id", "user_id")},
            **{c: d[c] for c in same},
            "is_delayed": d["actual_days"] > d["estimated_days"],
            "event_time": F.col("event_time"),
        },
    )


def silver_tables() -> list[Silver]:
    return [silver_orders(), silver_payments(), silver_deliveries()]


def silver_rows(parsed: DataFrame, silver: Silver) -> DataFrame:
    """Rows for one silver table that meet its constraints, one per key (lowest position)."""
    # the topic filter reaches the messages before they are parsed
    taken = parsed.filter((F.col("topic") == silver.topic) & silver.applies)
    carried = [c for c in NEEDED if c not in silver.columns]
    rows = taken.select(*silver.typed(), *carried, *POSITION)
    good = valid_rows(with_reason(rows, silver.rules()))
    return first_per_key(good.select(*silver.columns, *POSITION), silver.table.keys, POSITION)


def refused_events(parsed: DataFrame) -> DataFrame:
    """Messages that the parser or a table's constraints refuse:
    ``topic, value, rejection_reason`` and the position."""
    carried = ("topic", "value", *POSITION)
    kinds = silver_tables()
    # messages of other topics cannot be read
    other = ~F.coalesce(F.col("topic").isin([s.topic for s in kinds]), F.lit(False))
    refused = rejected_rows(with_reason(parsed.filter(other), bronze_rules()))
    refused = refused.select(*carried, "rejection_reason")
    for silver in kinds:
        rows = parsed.filter(F.col("topic") == silver.topic).select(
            *carried,
            *[c for c in NEEDED if c not in silver.columns],
            *silver.typed(),
            F.coalesce(silver.applies, F.lit(False)).alias("_applies"),
        )
        n = len(bronze_rules())
        own = [(F.col("_applies") & fails, why) for fails, why in silver.rules()[n:]]
        bad = rejected_rows(with_reason(rows, [*bronze_rules(), *own]))
        refused = refused.unionByName(bad.select(*carried, "rejection_reason"))
    return refused


def current_deliveries(deliveries: DataFrame) -> DataFrame:
    """The latest state of each delivery; of two at the same time, the delivered one."""
    ranked = deliveries.withColumn("_done", F.col("delivery_status") == "delivered")
    return last_per_key(ranked, ["delivery_id"], ["event_time", "_done"]).drop("_done")


def cancellations(parsed: DataFrame) -> DataFrame:
    """Cancellation events as ``order_id, cancelled_at``."""
    return parsed.filter(
        (F.col("event_type") == CANCELLED) & F.col("order.order_id").isNotNull()
    ).select(F.col("order.order_id").alias("order_id"), F.col("event_time").alias("cancelled_at"))


def apply_cancellations(orders: DataFrame, cancelled: DataFrame) -> DataFrame:
    """Orders with status ``cancelled`` where a cancellation event exists."""
    # one row per order, so that repeated cancellations do not multiply orders
    hits = lookup_ids(cancelled, "order_id").withColumn("_hit", F.lit(True))
    status = F.when(F.col("_hit"), F.lit("cancelled")).otherwise(F.col("order_status"))
    return (
        orders.join(hits, "order_id", "left")
        .withColumn("order_status", status)
        .select(*orders.columns)
    )
