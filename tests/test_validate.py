"""Golden cases of the row validators."""

import json

import pytest
from pyspark.sql import functions as F

from souk.operators.validate import check_constraints, rejected_rows, rules_for, unreadable, valid_rows, with_reason
from souk.sources.events import parse_flat
from souk.sources.schemas import DELIVERIES_TOPIC, ORDERS, ORDERS_TOPIC, PAYMENTS_TOPIC

ORDER = {
    "order_id": "O1", "customer_id": "C1", "customer_name": "A", "product_id": "P1", "product_name": "Lamp",
    "category": "Home", "quantity": 2, "price": 10.5, "total_amount": 21.0, "city": "Pune", "status": "placed",
    "timestamp": "2024-01-01T10:00:00",
}
PAYMENT = {"payment_id": "P1", "order_id": "O1", "amount": 21.0, "method": "UPI", "status": "success"}
DELIVERY = {"delivery_id": "D1", "order_id": "O1", "city": "Pune", "estimated_days": 3, "status": "dispatched"}

PRICE = "Invalid price — must be > 0"
CASES = [
    (ORDERS_TOPIC, ORDER, {}, None),
    (ORDERS_TOPIC, ORDER, {"order_id": ""}, "Missing order_id"),
    (ORDERS_TOPIC, ORDER, {"customer_id": None}, "Missing customer_id"),
    (ORDERS_TOPIC, ORDER, {"product_name": ""}, "Missing product_name"),
    (ORDERS_TOPIC, ORDER, {"price": -500, "total_amount": -500}, PRICE),
    (ORDERS_TOPIC, ORDER, {"price": None}, PRICE),
    (ORDERS_TOPIC, ORDER, {"price": "x"}, PRICE),
    (ORDERS_TOPIC, ORDER, {"price": "12.5"}, None),
    (ORDERS_TOPIC, ORDER, {"total_amount": 0}, "Invalid total_amount — must be > 0"),
    (ORDERS_TOPIC, ORDER, {"quantity": 0}, "Invalid quantity — must be > 0"),
    (ORDERS_TOPIC, ORDER, {"quantity": 0.9}, "Invalid quantity — must be > 0"),
    (ORDERS_TOPIC, ORDER, {"quantity": 1.9}, None),
    (ORDERS_TOPIC, ORDER, {"status": "shipped"}, "Invalid status: shipped"),
    (ORDERS_TOPIC, ORDER, {"status": None}, "Invalid status: None"),
    (ORDERS_TOPIC, ORDER, {"order_id": "", "status": "shipped"}, "Missing order_id"),
    (PAYMENTS_TOPIC, PAYMENT, {}, None),
    (PAYMENTS_TOPIC, PAYMENT, {"payment_id": None}, "Missing payment_id"),
    (PAYMENTS_TOPIC, PAYMENT, {"order_id": ""}, "Missing order_id"),
    (PAYMENTS_TOPIC, PAYMENT, {"amount": 0}, "Invalid amount — must be > 0"),
    (PAYMENTS_TOPIC, PAYMENT, {"method": "EMI"}, "Invalid payment method: EMI"),
    (PAYMENTS_TOPIC, PAYMENT, {"status": "open"}, "Invalid payment status: open"),
    (DELIVERIES_TOPIC, DELIVERY, {}, None),
    (DELIVERIES_TOPIC, DELIVERY, {"delivery_id": ""}, "Missing delivery_id"),
    (DELIVERIES_TOPIC, DELIVERY, {"city": None}, "Missing city"),
    (DELIVERIES_TOPIC, DELIVERY, {"estimated_days": 0}, "Invalid estimated_days — must be > 0"),
    (DELIVERIES_TOPIC, DELIVERY, {"status": "lost"}, "Invalid delivery status: lost"),
]


def message(spark, topic, texts):
    rows = [(t, topic, 0, i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "value STRING, topic STRING, partition INT, offset LONG")


@pytest.mark.parametrize("topic", [ORDERS_TOPIC, PAYMENTS_TOPIC, DELIVERIES_TOPIC])
def test_golden_reasons(spark, topic):
    cases = [(json.dumps({**base, **change}), reason) for t, base, change, reason in CASES if t == topic]
    parsed = parse_flat(message(spark, topic, [c[0] for c in cases]), topic)
    checked = with_reason(parsed, [unreadable(), *rules_for(topic)])
    got = [r.rejection_reason for r in checked.orderBy("offset").collect()]
    assert got == [c[1] for c in cases]
    assert valid_rows(checked).count() + rejected_rows(checked).count() == len(cases)


def test_missing_field_and_malformed_text(spark):
    without_price = {k: v for k, v in ORDER.items() if k != "price"}
    parsed = parse_flat(message(spark, ORDERS_TOPIC, [json.dumps(without_price), '{"order_id": "O', "7"]), ORDERS_TOPIC)
    checked = with_reason(parsed, [unreadable(), *rules_for(ORDERS_TOPIC)])
    got = [r.rejection_reason for r in checked.orderBy("offset").collect()]
    assert got == [PRICE, "Malformed JSON", "Malformed JSON"]


def test_constraints_let_null_pass_a_check(spark):
    rows = spark.createDataFrame(
        [("a", 1, "5"), ("b", None, None), ("c", 0, "1"), ("d", 1, "-1"), (None, 1, "1")],
        "order_id STRING, quantity INT, amount STRING",
    ).select(
        "order_id", "quantity", F.col("amount").cast("decimal(12,2)").alias("total_amount"),
        F.lit(1).cast("decimal(10,2)").alias("unit_price"), F.lit("u").alias("user_id"),
        F.lit("p").alias("product_id"), F.current_timestamp().alias("event_time"),
    )
    got = {r.order_id: r.rejection_reason for r in check_constraints(rows, ORDERS).collect()}
    assert got == {
        "a": None, "b": None, "c": "quantity violates quantity > 0",
        "d": "total_amount violates total_amount >= 0", None: "order_id is null",
    }
