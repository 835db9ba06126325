"""Orders whose payment did not come in time, from two streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from souk.streaming.windows import to_files


def unpaid_orders(
    orders: DataFrame,
    payments: DataFrame,
    within: str = "1 hour",
    delay: str = "1 hour",
    order_time: str = "event_time",
    payment_time: str = "event_time",
) -> DataFrame:
    """Orders without a payment from their own time to ``within`` after it (both ends count).

    An order is passed on once, when the watermark, ``delay`` behind the slower stream, says that no such payment can
    arrive any more; until then it is open. Both sides' state is dropped behind the watermark: orders after
    ``within``, payments at once. A payment that comes later than that, or before its order, does not count. Rows
    that arrive later than ``delay`` are left out. Orders come once each (:func:`souk.streaming.windows.deduplicated`).
    Run it in append mode.
    """
    paid = payments.filter(F.col("payment_id").isNotNull() & F.col("order_id").isNotNull()).select(
        F.col("order_id").alias("_paid_order"), F.col(payment_time).alias("_paid_at")
    )
    ordered, paid = orders.withWatermark(order_time, delay), paid.withWatermark("_paid_at", delay)
    in_time = (
        (F.col("order_id") == F.col("_paid_order"))
        & (F.col("_paid_at") >= F.col(order_time))
        & (F.col("_paid_at") <= F.col(order_time) + F.expr(f"INTERVAL {within}"))
    )
    joined = ordered.join(paid, in_time, "left_outer")
    return joined.filter(F.col("_paid_order").isNull()).select(*orders.columns)


def run(
    orders: DataFrame, payments: DataFrame, path: str, checkpoint: str, trigger: str | None = "1 minute", **bounds: str
) -> StreamingQuery:
    """Add the unpaid orders to Parquet files; ``bounds`` as in :func:`unpaid_orders`."""
    return to_files(unpaid_orders(orders, payments, **bounds), path, checkpoint, trigger, mode="append")
