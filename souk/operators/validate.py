"""Row validation: ordered rule lists, first failing rule gives the reason.

A rule is ``(fails, reason)``. ``rejection_reason`` is NULL for good rows. Rules are plain
expressions, so other tables get their own list without new code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.sources.schemas import (
    DELIVERIES_TOPIC,
    DELIVERY_STATES,
    ORDER_STATES,
    ORDERS_TOPIC,
    PAYMENT_METHODS,
    PAYMENT_STATES,
    PAYMENTS_TOPIC,
    Table,
)

Rule = tuple[Column, Column]

# fixed values: reason texts
MALFORMED = "Malformed JSON"
MISSING = "Missing {}"
NOT_POSITIVE = "Invalid {} — must be > 0"
UNKNOWN = "Invalid {}: "
ABSENT = "None"
UNFIT = "Invalid {} — not a {}"


def missing(column: str) -> Rule:
    """NULL or empty text."""
    text = F.col(column).cast("string")
    return text.isNull() | (text == ""), F.lit(MISSING.format(column))


def not_positive(column: str, whole: bool = False) -> Rule:
    """Absent, not a number, or not above zero; ``whole`` drops the fraction first."""
    number = F.col(column).try_cast("double")
    if whole:
        number = number.try_cast("bigint")
    return ~F.coalesce(number > 0, F.lit(False)), F.lit(NOT_POSITIVE.format(column))


def unfit(column: str, dtype: str, value: Column | None = None) -> Rule:
    """A value that is there but cannot be stored as ``dtype``: too wide, not finite, or no such
    thing. It is refused, as storing it would silently make it NULL."""
    given = F.col(column) if value is None else value
    stored = F.try_to_timestamp(given) if dtype == "timestamp" else given.try_cast(dtype)
    if dtype == "int":  # "1.9" counts as 1, like a number in the message
        stored = given.try_cast("double").try_cast("int")
    return given.isNotNull() & stored.isNull(), F.lit(UNFIT.format(column, dtype))


def not_among(column: str, allowed: Sequence[str], label: str) -> Rule:
    """Not one of the accepted values; an absent one is named in the reason as ``None``."""
    value = F.col(column)
    known = F.coalesce(value.isin(*allowed), F.lit(False))
    return ~known, F.concat(F.lit(UNKNOWN.format(label)), F.coalesce(value, F.lit(ABSENT)))


def order_rules() -> list[Rule]:
    return [
        missing("order_id"),
        missing("customer_id"),
        missing("product_name"),
        not_positive("price"),
        not_positive("total_amount"),
        not_positive("quantity", whole=True),
        not_among("status", ORDER_STATES, "status"),
    ]


def payment_rules() -> list[Rule]:
    return [
        missing("payment_id"),
        missing("order_id"),
        not_positive("amount"),
        not_among("method", PAYMENT_METHODS, "payment method"),
        not_among("status", PAYMENT_STATES, "payment status"),
    ]


def delivery_rules() -> list[Rule]:
    return [
        missing("delivery_id"),
        missing("order_id"),
        missing("city"),
        not_positive("estimated_days", whole=True),
        not_among("status", DELIVERY_STATES, "delivery status"),
    ]


def rules_for(topic: str) -> list[Rule]:
    return {
        ORDERS_TOPIC: order_rules,
        PAYMENTS_TOPIC: payment_rules,
        DELIVERIES_TOPIC: delivery_rules,
    }[topic]()


def unreadable() -> Rule:
    """Text that is not a JSON object (set by the parser)."""
    return F.col("corrupt").isNotNull(), F.lit(MALFORMED)


def with_reason(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` plus ``rejection_reason``."""
    (fails, reason), *others = rules
    choice = F.when(fails, reason)
    for fails, reason in others:
        choice = choice.when(fails, reason)
    return df.withColumn("rejection_reason", choice)


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("rejection_reason").isNull()).drop("rejection_reason")


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("rejection_reason").isNotNull())


def rejected_records(df: DataFrame, topic: str) -> DataFrame:
    """The refused rows of one flat topic as ``topic, record_data, rejection_reason``."""
    bad = rejected_rows(with_reason(df, rules_for(topic)))
    return bad.select(
        F.lit(topic).alias("topic"),
        F.to_json(F.struct(*df.columns)).alias("record_data"),
        "rejection_reason",
    )


def reason_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("topic", "rejection_reason").agg(F.count(F.lit(1)).alias("records"))


def constraint_rules(table: Table) -> list[Rule]:
    """The table's NOT NULL and CHECK constraints; NULL passes a CHECK, as in SQL."""
    rules = [(F.col(c).isNull(), F.lit(f"{c} is null")) for c in table.not_null]
    rules += [
        (~F.coalesce(F.expr(condition), F.lit(True)), F.lit(f"{name} violates {condition}"))
        for name, condition in table.checks.items()
    ]
    return rules


def check_constraints(df: DataFrame, table: Table) -> DataFrame:
    """``df`` with the first violated constraint as ``rejection_reason``."""
    return with_reason(df, constraint_rules(table))
