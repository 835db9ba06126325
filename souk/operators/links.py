"""Joins between orders, payments and events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.grouping import lookup_ids
from souk.functions.times import on_day


def paid_order_ids(payments: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """The distinct order ids that payments refer to; with ``orders``, only those among them.

    A few orders are looked up in all payments that way without shuffling the payments.
    """
    paid = payments.filter(F.col("payment_id").isNotNull()).select("order_id")
    if orders is not None:
        paid = paid.join(lookup_ids(orders, "order_id"), "order_id", "left_semi")
    return lookup_ids(paid, "order_id")


def orders_without_payment(
    orders: DataFrame, payments: DataFrame, day: str | date | None = None, ts: str = "timestamp"
) -> DataFrame:
    """Orders (of one day, or all) that no payment refers to."""
    if day is None:
        return orders.join(paid_order_ids(payments), "order_id", "left_anti")
    some = orders.filter(on_day(orders, ts, day))
    return some.join(paid_order_ids(payments, some), "order_id", "left_anti")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row."""
    known = lookup_ids(parent.select(F.col(parent_key or key).alias("_parent")), "_parent")
    return child.filter(F.col(key).isNotNull()).join(
        known, F.col(key) == F.col("_parent"), "left_anti"
    )


def order_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Each payment next to its order (payment columns that clash get the prefix ``payment_``)."""
    shared = set(orders.columns) & set(payments.columns) - {"order_id"}
    renamed = payments.withColumnsRenamed({c: f"payment_{c}" for c in shared})
    return orders.join(renamed, "order_id")


def topic_throughput(messages: DataFrame, ts: str = "timestamp", width: str = "1 minute") -> DataFrame:
    """Messages per topic and time slot; works on a batch and on a stream."""
    return (
        messages.groupBy(F.window(ts, width).alias("slot"), "topic")
        .agg(F.count(F.lit(1)).alias("messages"))
        .select(F.col("slot.start").alias("slot_start"), "topic", "messages")
    )
