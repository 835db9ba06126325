"""KPI tables kept up to date by deltas instead of being computed anew.

Additive figures are merged into the partitions a delta touches. What is not additive is kept as something
that is: the latest state per delivery, whose changes are subtracted as they were and added as they are; and counts
per customer and value, from which first and last day and favourites follow even after cancellations.
Every table records what it reflects, so a repeated or interrupted refresh goes on where it stopped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.money import percent, ratio
from souk.functions.times import AsOf, moment
from souk.operators import gold
from souk.operators.medallion import current_deliveries
from souk.sinks.versioned import (
    changed_parts,
    commit_parts,
    current,
    merge_version,
    named,
    replace_version,
    signed_changes,
)
from souk.sources.schemas import CUSTOMER_METRICS, DELAYED_SHIPMENTS, Table, key_bucket
from souk.sources.tables import conform, read_folders, read_table

DELIVERY_STATE = Table(
    "gold.delivery_state",
    "delivery_id STRING, delivery_status STRING, city STRING, estimated_days INT, actual_days INT, event_time TIMESTAMP",
    keys=("delivery_id",),
    partition=key_bucket("delivery_id", buckets=16),
    key_fixes_partition=True,
)
CUSTOMER_TALLY = Table(
    "gold.customer_tally",
    "user_id STRING, kind STRING, value STRING, orders LONG, priced LONG, amount DECIMAL(22,2)",
    keys=("user_id", "kind", "value"),
    partition=key_bucket("user_id"),
    key_fixes_partition=True,
)


# --- late shipments per day and city ----------------------------------------------------------------


def add_deliveries(deliveries: DataFrame, root: str, batch: str) -> None:
    """Take new delivery events into the latest state per delivery; ``batch`` names the delta."""

    def latest(stored: DataFrame, new: DataFrame) -> DataFrame:
        return current_deliveries(stored.unionByName(new))

    merge_version(deliveries, DELIVERY_STATE, root, latest, mark=batch)


def _added(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Shipments of both, without days and cities that have none any more."""
    sums = stored.unionByName(new).groupBy(*DELAYED_SHIPMENTS.keys).agg(
        *[F.sum(c).alias(c) for c in ("delayed_count", "total_shipments")]
    )
    rate = percent(F.col("delayed_count"), F.col("total_shipments"))
    return sums.where("total_shipments > 0").withColumn("delay_rate", rate)


def refresh_delayed_shipments(spark: SparkSession, root: str) -> None:
    """Bring the late shipments to the last version of the delivery state.

    Only buckets that changed since are read: each delivery there is subtracted as it was and added as it
    is. If that version is no longer kept, everything is counted again.
    """
    number, _ = current(spark, DELIVERY_STATE, root)
    _, content = current(spark, DELAYED_SHIPMENTS, root)
    if content["mark"] == number:
        return
    changes = signed_changes(spark, DELIVERY_STATE, root, content["mark"] or 0)
    if changes is None:
        return replace_version(gold.delayed_shipments(read_table(spark, DELIVERY_STATE, root)), DELAYED_SHIPMENTS, root, mark=number)
    late = F.when(F.col("actual_days") > F.col("estimated_days"), F.col("sign")).otherwise(0)
    deltas = changes.groupBy(F.to_date("event_time").alias("date_bucket"), "city").agg(
        F.sum(late).alias("delayed_count"), F.sum("sign").alias("total_shipments")
    )
    merge_version(deltas.where("delayed_count <> 0 or total_shipments <> 0"), DELAYED_SHIPMENTS, root, _added, mark=number)


# --- customers --------------------------------------------------------------------------------------


def _tallied(orders: DataFrame, sign: int) -> DataFrame:
    """Counts of live orders per customer and day, category and payment method."""
    source = {"day": F.to_date("event_time").cast("string"), "category": F.col("product_category"), "payment": F.col("payment_method")}
    values = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in source.items()])
    rows = orders.select("user_id", "total_amount", F.inline(values))
    return rows.groupBy("user_id", "kind", "value").agg(
        (F.count(F.lit(1)) * sign).alias("orders"),
        (F.count("total_amount") * sign).alias("priced"),
        (F.coalesce(F.sum("total_amount"), F.lit(0)) * sign).cast("decimal(22,2)").alias("amount"),
    )


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*CUSTOMER_TALLY.keys).agg(*[F.sum(c).alias(c) for c in ("orders", "priced", "amount")])


def _summed(stored: DataFrame, new: DataFrame) -> DataFrame:
    return _sums(stored.unionByName(new)).where("orders <> 0")


def add_orders(root: str, batch: str, placed: DataFrame | None = None, cancelled: DataFrame | None = None) -> None:
    """Add orders to the customers' counts and take out those that were cancelled since, whole rows
    both. ``batch`` names the delta."""
    parts = [_tallied(rows, sign) for rows, sign in ((placed, 1), (cancelled, -1)) if rows is not None]
    delta = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    merge_version(_sums(delta), CUSTOMER_TALLY, root, _summed, mark=batch)


def _favourite(kind: str) -> Column:
    """The most frequent value, the first by name among equals; missing values do not count."""
    wanted = (F.col("kind") == kind) & F.col("value").isNotNull()
    return F.min(F.when(wanted, F.struct(-F.col("orders"), "value")))["value"]


def metrics_of(tally: DataFrame) -> DataFrame:
    """Lifetime figures per customer, but for those that depend on today."""
    days = F.col("kind") == "day"
    people = tally.groupBy("user_id").agg(
        F.sum(F.when(days, F.col("orders"))).alias("total_orders"),
        F.sum(F.when(days, F.col("priced"))).alias("_priced"),
        F.sum(F.when(days, F.col("amount"))).alias("total_spend"),
        F.min(F.when(days, F.col("value"))).cast("date").alias("first_order_date"),
        F.max(F.when(days, F.col("value"))).cast("date").alias("last_order_date"),
        _favourite("category").alias("favourite_category"),
        _favourite("payment").alias("favourite_payment"),
    )
    return people.withColumn("avg_order_value", ratio(F.col("total_spend"), F.col("_priced"), "decimal(12,2)")).drop("_priced")


def refresh_customer_metrics(spark: SparkSession, root: str) -> None:
    """Bring the metrics to the last version of the counts; only customers in changed buckets are written.

    Both tables have the same buckets, so a customer without orders left goes with the bucket's old rows.
    """
    number, now = current(spark, CUSTOMER_TALLY, root)
    _, content = current(spark, CUSTOMER_METRICS, root)
    if content["mark"] == number:
        return
    changed = changed_parts(spark, CUSTOMER_TALLY, root, content["mark"] or 0)
    names = {*now["parts"], *content["parts"]} if changed is None else {*changed[0], *changed[1]}
    tally = read_folders(spark, CUSTOMER_TALLY, root, {n: v for n, v in now["parts"].items() if n in names})
    commit_parts(conform(metrics_of(tally), CUSTOMER_METRICS), CUSTOMER_METRICS, root, named(names), mark=number)


def customer_metrics(spark: SparkSession, root: str, as_of: AsOf = None, churn_after: int = gold.CHURN_RISK_AFTER_DAYS) -> DataFrame:
    """The kept metrics with the days since the last order and the churn flag as of a day."""
    rows = read_table(spark, CUSTOMER_METRICS, root)
    days = F.datediff(F.to_date(moment(as_of)), F.col("last_order_date"))
    return rows.withColumns({"days_since_last_order": days, "churn_risk_flag": days > churn_after})
