"""Message schemas and table contracts.

Field names, topics and allowed values are the wire format and table layout that existing
producers and readers use; they are fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# --- fixed values: topics -------------------------------------------------------------
ORDERS_TOPIC = "ecom.orders"
PAYMENTS_TOPIC = "ecom.payments"
DELIVERIES_TOPIC = "ecom.deliveries"
TOPICS = (ORDERS_TOPIC, PAYMENTS_TOPIC, DELIVERIES_TOPIC)

# --- fixed values: event types and the topic each one travels on ------------------------
EVENT_TOPIC = {
    "order_placed": ORDERS_TOPIC,
    "payment_success": PAYMENTS_TOPIC,
    "payment_failed": PAYMENTS_TOPIC,
    "order_shipped": DELIVERIES_TOPIC,
    "order_delivered": DELIVERIES_TOPIC,
    "order_cancelled": ORDERS_TOPIC,
    "cart_abandoned": ORDERS_TOPIC,
}
EVENT_TYPES = tuple(EVENT_TOPIC)

# --- fixed values: accepted states of the flat dialect ----------------------------------
ORDER_STATES = ("placed", "confirmed", "processing")
PAYMENT_METHODS = ("UPI", "Credit Card", "Debit Card", "Net Banking", "COD")
PAYMENT_STATES = ("success", "failed")
DELIVERY_STATES = ("dispatched", "in_transit", "out_for_delivery")

# --- fixed values: JSON fields of the event dialect, per topic --------------------------
CORRUPT = "_corrupt"
ORDER_EVENT = f"""
    event_id STRING, event_type STRING, timestamp STRING, user_id STRING, session_id STRING,
    order_id STRING, product_id STRING, product_name STRING, product_category STRING,
    quantity INT, unit_price DOUBLE, total_amount DOUBLE, payment_method STRING, city STRING,
    state STRING, device STRING, pincode STRING, cancel_reason STRING, refund_amount DOUBLE,
    refund_method STRING, cart_value DOUBLE, abandonment_reason STRING, {CORRUPT} STRING
"""
PAYMENT_EVENT = f"""
    event_id STRING, event_type STRING, timestamp STRING, payment_id STRING, order_id STRING,
    user_id STRING, amount DOUBLE, payment_method STRING, payment_status STRING,
    failure_reason STRING, {CORRUPT} STRING
"""
DELIVERY_EVENT = f"""
    event_id STRING, event_type STRING, timestamp STRING, delivery_id STRING, order_id STRING,
    user_id STRING, delivery_status STRING, city STRING, state STRING, estimated_days INT,
    actual_days INT, courier_partner STRING, {CORRUPT} STRING
"""

# --- fixed values: JSON fields of the flat dialect --------------------------------------
# Numbers are read as text: the validator decides what is a number, not the JSON reader.
FLAT_ORDER = f"""
    order_id STRING, customer_id STRING, customer_name STRING, product_id STRING,
    product_name STRING, category STRING, quantity STRING, price STRING, total_amount STRING,
    city STRING, status STRING, timestamp STRING, {CORRUPT} STRING
"""
FLAT_PAYMENT = f"""
    payment_id STRING, order_id STRING, amount STRING, method STRING, status STRING,
    timestamp STRING, {CORRUPT} STRING
"""
FLAT_DELIVERY = f"""
    delivery_id STRING, order_id STRING, city STRING, status STRING, estimated_days STRING,
    timestamp STRING, {CORRUPT} STRING
"""
FLAT_BY_TOPIC = {
    ORDERS_TOPIC: FLAT_ORDER,
    PAYMENTS_TOPIC: FLAT_PAYMENT,
    DELIVERIES_TOPIC: FLAT_DELIVERY,
}

# columns of a message as the Kafka source delivers it
MESSAGE = "key STRING, value STRING, topic STRING, partition INT, offset LONG, timestamp TIMESTAMP"

KEY_BUCKETS = 64


@dataclass(frozen=True)
class TimePartition:
    """Rows are stored by the day or month of a time column."""

    name: str
    column: str
    unit: str = "day"
    dtype: str = "DATE"

    def of(self, moment: Column) -> Column:
        """The partition a moment belongs to."""
        day = F.to_date(moment)
        return day if self.unit == "day" else F.trunc(day, self.unit)

    def value(self) -> Column:
        return self.of(F.col(self.column)).alias(self.name)


@dataclass(frozen=True)
class KeyPartition:
    """Rows are stored by an expression of their key."""

    name: str
    expression: str
    dtype: str = "INT"

    def value(self) -> Column:
        return F.expr(self.expression).cast(self.dtype).alias(self.name)


def key_bucket(*keys: str, buckets: int = KEY_BUCKETS) -> KeyPartition:
    return KeyPartition("key_bucket", f"pmod(xxhash64({', '.join(keys)}), {buckets})")


@dataclass(frozen=True)
class Table:
    """A table's contract.

    ``key_fixes_partition``: the key holds the partition value, so rows of one key always fall into
    one partition and writers look a key up in the partitions of the new rows only.
    """

    name: str
    columns: str
    keys: tuple[str, ...] = ()
    partition: TimePartition | KeyPartition | None = None
    key_fixes_partition: bool = False
    defaults: dict[str, str] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        """Columns as stored, the partition column last."""
        extra = f", {self.partition.name} {self.partition.dtype}" if self.partition else ""
        return StructType.fromDDL(self.columns + extra)

    def path(self, root: str) -> str:
        return f"{root}/{self.name.replace('.', '/')}"


NOW = {"processed_at": "current_timestamp()"}
REFRESHED = {"refreshed_at": "current_timestamp()"}

# --- fixed values: table layouts. Surrogate ids are left out (the natural key identifies a
# row); sums and counts are wider than in a small database so that they do not overflow.
RAW_EVENTS = Table(
    "bronze.raw_events",
    "event_id STRING, event_type STRING, raw_payload STRING, kafka_topic STRING, "
    "kafka_partition INT, kafka_offset LONG, event_time TIMESTAMP, ingested_at TIMESTAMP",
    keys=("event_id",),
    partition=TimePartition("event_date", "event_time"),
    defaults={"ingested_at": "current_timestamp()"},
    not_null=("event_id", "event_type", "raw_payload"),
)
ORDERS = Table(
    "silver.orders",
    "order_id STRING, event_id STRING, user_id STRING, session_id STRING, product_id STRING, "
    "product_category STRING, quantity INT, unit_price DECIMAL(10,2), total_amount DECIMAL(12,2), "
    "payment_method STRING, city STRING, state STRING, device STRING, order_status STRING, "
    "event_time TIMESTAMP, processed_at TIMESTAMP, is_valid BOOLEAN",
    keys=("order_id",),
    partition=TimePartition("event_date", "event_time"),
    defaults={"order_status": "'placed'", "is_valid": "true", **NOW},
    not_null=("order_id", "user_id", "product_id", "event_time"),
    checks={
        "quantity": "quantity > 0",
        "unit_price": "unit_price >= 0",
        "total_amount": "total_amount >= 0",
    },
)
PAYMENTS = Table(
    "silver.payments",
    "payment_id STRING, order_id STRING, user_id STRING, amount DECIMAL(12,2), "
    "payment_method STRING, payment_status STRING, failure_reason STRING, "
    "event_time TIMESTAMP, processed_at TIMESTAMP",
    keys=("payment_id",),
    partition=TimePartition("event_date", "event_time"),
    defaults=NOW,
    not_null=("payment_id", "user_id", "event_time"),
    checks={"amount": "amount >= 0"},
)
# One row per delivery and event: a delivery keeps its id from "shipped" to "delivered", and
# readers take the latest (operators.medallion.current_deliveries).
DELIVERIES = Table(
    "silver.deliveries",
    "delivery_id STRING, order_id STRING, user_id STRING, delivery_status STRING, city STRING, "
    "estimated_days INT, actual_days INT, is_delayed BOOLEAN, event_time TIMESTAMP, "
    "processed_at TIMESTAMP",
    keys=("delivery_id", "event_time", "delivery_status"),
    partition=TimePartition("event_date", "event_time"),
    key_fixes_partition=True,
    defaults=NOW,
    not_null=("delivery_id", "user_id", "event_time"),
)
HOURLY_REVENUE = Table(
    "gold.hourly_revenue",
    "hour_bucket TIMESTAMP, product_category STRING, total_revenue DECIMAL(22,2), "
    "order_count LONG, avg_order_value DECIMAL(12,2), refreshed_at TIMESTAMP",
    keys=("hour_bucket", "product_category"),
    partition=TimePartition("bucket_date", "hour_bucket"),
    key_fixes_partition=True,
    defaults={"total_revenue": "0", "order_count": "0", "avg_order_value": "0", **REFRESHED},
)
DAILY_REVENUE = Table(
    "gold.daily_revenue",
    "date_bucket DATE, total_revenue DECIMAL(22,2), order_count LONG, unique_customers LONG, "
    "avg_order_value DECIMAL(12,2), top_category STRING, refreshed_at TIMESTAMP",
    keys=("date_bucket",),
    partition=TimePartition("bucket_month", "date_bucket", "month"),
    key_fixes_partition=True,
    defaults={
        "total_revenue": "0", "order_count": "0", "unique_customers": "0",
        "avg_order_value": "0", **REFRESHED,
    },
)
REVENUE_BY_CITY = Table(
    "gold.revenue_by_city",
    "date_bucket DATE, city STRING, total_revenue DECIMAL(22,2), order_count LONG, "
    "refreshed_at TIMESTAMP",
    keys=("date_bucket", "city"),
    partition=TimePartition("bucket_month", "date_bucket", "month"),
    key_fixes_partition=True,
    defaults={"total_revenue": "0", "order_count": "0", **REFRESHED},
)
PAYMENT_FAILURES = Table(
    "gold.payment_failure_metrics",
    "hour_bucket TIMESTAMP, payment_method STRING, total_attempts LONG, failed_count LONG, "
    "failure_rate DECIMAL(5,2), refreshed_at TIMESTAMP",
    keys=("hour_bucket", "payment_method"),
    partition=TimePartition("bucket_date", "hour_bucket"),
    key_fixes_partition=True,
    defaults={"total_attempts": "0", "failed_count": "0", "failure_rate": "0", **REFRESHED},
)
CUSTOMER_METRICS = Table(
    "gold.customer_metrics",
    "user_id STRING, total_orders LONG, total_spend DECIMAL(22,2), avg_order_value DECIMAL(12,2), "
    "first_order_date DATE, last_order_date DATE, days_since_last_order INT, "
    "favourite_category STRING, favourite_payment STRING, churn_risk_flag BOOLEAN, "
    "refreshed_at TIMESTAMP",
    keys=("user_id",),
    partition=key_bucket("user_id"),
    key_fixes_partition=True,
    defaults={
        "total_orders": "0", "total_spend": "0", "avg_order_value": "0",
        "churn_risk_flag": "false", **REFRESHED,
    },
)
DELAYED_SHIPMENTS = Table(
    "gold.delayed_shipments",
    "date_bucket DATE, city STRING, delayed_count LONG, total_shipments LONG, "
    "delay_rate DECIMAL(5,2), refreshed_at TIMESTAMP",
    keys=("date_bucket", "city"),
    partition=TimePartition("bucket_month", "date_bucket", "month"),
    key_fixes_partition=True,
    defaults={"delayed_count": "0", "total_shipments": "0", "delay_rate": "0", **REFRESHED},
)
DQ_RUN_LOG = Table(
    "public.dq_run_log",
    "run_id STRING, layer STRING, table_name STRING, check_name STRING, status STRING, "
    "records_checked LONG, records_failed LONG, run_at TIMESTAMP",
    defaults={"run_at": "current_timestamp()"},
)
DATA_QUALITY_LOG = Table(
    "public.data_quality_log",
    "check_date DATE, null_values LONG, negative_amounts LONG, duplicate_orders LONG, "
    "unmatched_payments LONG, payment_fail_rate DECIMAL(5,2), status STRING, created_at TIMESTAMP",
    defaults={"created_at": "current_timestamp()"},
)
PRODUCTS = Table(
    "public.products",
    "product_id STRING, product_name STRING, category STRING, base_price DECIMAL(10,2)",
    keys=("product_id",),
)
# Flat ids are short numbers that may come back later, so the month does not follow from the key
# and writers look conflicts up in the whole table.
FLAT_ORDERS = Table(
    "public.orders",
    "order_id STRING, customer_id STRING, customer_name STRING, product_id STRING, "
    "product_name STRING, category STRING, quantity INT, price DECIMAL(12,2), "
    "total_amount DECIMAL(12,2), city STRING, status STRING, timestamp TIMESTAMP",
    keys=("order_id",),
    partition=TimePartition("order_month", "timestamp", "month"),
)
FLAT_PAYMENTS = Table(
    "public.payments",
    "payment_id STRING, order_id STRING, amount DECIMAL(12,2), method STRING, status STRING, "
    "timestamp TIMESTAMP",
    keys=("payment_id",),
    partition=TimePartition("payment_month", "timestamp", "month"),
)
FLAT_DELIVERIES = Table(
    "public.deliveries",
    "delivery_id STRING, order_id STRING, city STRING, status STRING, estimated_days INT, "
    "timestamp TIMESTAMP",
    keys=("delivery_id",),
    partition=TimePartition("delivery_month", "timestamp", "month"),
)
FLAT_TABLES = {
    ORDERS_TOPIC: FLAT_ORDERS,
    PAYMENTS_TOPIC: FLAT_PAYMENTS,
    DELIVERIES_TOPIC: FLAT_DELIVERIES,
}
# The message position makes a replayed batch harmless; its range limits the lookup.
REJECTED = Table(
    "public.rejected_records",
    "topic STRING, record_data STRING, rejection_reason STRING, kafka_partition INT, "
    "kafka_offset LONG, rejected_at TIMESTAMP",
    keys=("topic", "kafka_partition", "kafka_offset"),
    partition=KeyPartition("offset_range", "kafka_offset div 10000000", "LONG"),
    key_fixes_partition=True,
    defaults={"rejected_at": "current_timestamp()"},
)
CUSTOMER_SEGMENTS = Table(
    "public.customer_segments",
    "customer_id STRING, total_orders LONG, total_spent DECIMAL(22,2), "
    "avg_order_value DECIMAL(12,2), last_order_date TIMESTAMP, days_since_last_order INT, "
    "segment STRING, created_at TIMESTAMP",
    keys=("customer_id",),
    partition=key_bucket("customer_id"),
    key_fixes_partition=True,
    defaults={"created_at": "current_timestamp()"},
)
REVENUE_FORECAST = Table(
    "public.revenue_forecast",
    "forecast_date DATE, predicted_revenue DECIMAL(24,2), avg_last_7_days DECIMAL(22,2), "
    "std_revenue DOUBLE, actual_revenue DECIMAL(22,2), accuracy_pct DECIMAL(24,2)",
    keys=("forecast_date",),
    partition=TimePartition("forecast_month", "forecast_date", "month"),
    key_fixes_partition=True,
)
DAILY_SUMMARY = Table(
    "public.daily_summary",
    "summary_date DATE, total_orders LONG, total_revenue DECIMAL(22,2), "
    "avg_order_value DECIMAL(12,2), top_product STRING, top_city STRING, "
    "successful_payments LONG, failed_payments LONG",
    keys=("summary_date",),
    partition=TimePartition("summary_month", "summary_date", "month"),
    key_fixes_partition=True,
)
HOURLY_STATS = Table(
    "public.hourly_stats",
    "stat_date DATE, stat_hour INT, total_orders LONG, total_revenue DECIMAL(22,2), "
    "successful_payments LONG, failed_payments LONG, top_product STRING, top_city STRING, "
    "created_at TIMESTAMP",
    keys=("stat_date", "stat_hour"),
    partition=TimePartition("stat_month", "stat_date", "month"),
    key_fixes_partition=True,
    defaults={"created_at": "current_timestamp()"},
)
DELIVERY_ANALYSIS = Table(
    "public.delivery_analysis",
    "analysis_date DATE, city STRING, total_deliveries LONG, dispatched_count LONG, "
    "in_transit_count LONG, out_for_delivery_count LONG, avg_estimated_days DECIMAL(12,2), "
    "fast_deliveries LONG, slow_deliveries LONG",
    keys=("analysis_date", "city"),
    partition=TimePartition("analysis_month", "analysis_date", "month"),
    key_fixes_partition=True,
)
TOPIC_THROUGHPUT = Table(
    "public.topic_throughput",
    "slot_start TIMESTAMP, topic STRING, messages LONG",
    keys=("slot_start", "topic"),
    partition=TimePartition("slot_date", "slot_start"),
    key_fixes_partition=True,
)

TABLES = {
    t.name: t
    for t in (
        RAW_EVENTS, ORDERS, PAYMENTS, DELIVERIES, HOURLY_REVENUE, DAILY_REVENUE, REVENUE_BY_CITY,
        PAYMENT_FAILURES, CUSTOMER_METRICS, DELAYED_SHIPMENTS, DQ_RUN_LOG, DATA_QUALITY_LOG,
        PRODUCTS, FLAT_ORDERS, FLAT_PAYMENTS, FLAT_DELIVERIES, REJECTED, CUSTOMER_SEGMENTS,
        REVENUE_FORECAST, DAILY_SUMMARY, HOURLY_STATS, DELIVERY_ANALYSIS, TOPIC_THROUGHPUT,
    )
}
