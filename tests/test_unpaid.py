"""Orders that are not paid in time, from two streams."""

import pytest

from souk.streaming import unpaid

ORDER, PAYMENT = "order_id string, event_time timestamp", "payment_id string, order_id string, event_time timestamp"


def files(spark, path, schema, batches):
    """Each list of rows is one file, which is one micro-batch."""
    for rows in batches:
        typed = spark.createDataFrame(rows, schema.replace("timestamp", "string"))
        typed.withColumn("event_time", typed["event_time"].cast("timestamp")).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def found(spark, path):
    return sorted(r["order_id"] for r in spark.read.schema(ORDER).parquet(f"{path}/out").collect())


def at(clock, day=1):
    return f"2024-01-{day:02} {clock}"


BOUNDS = {"within": "1 hour", "delay": "2 hours"}


def test_unpaid_orders(spark, tmp_path):
    orders = files(spark, f"{tmp_path}/orders", ORDER, [
        [(x, at("10:00:00")) for x in ("in time", "at the bound", "late", "never", "before", "twice", "paid later batch", "null payment")],
        [("other", at("11:30:00"))],
        [("clock", at("00:00:00", 3)), ("open", at("22:30:00", 2))],
    ])
    payments = files(spark, f"{tmp_path}/payments", PAYMENT, [
        [("p1", "in time", at("10:20:00")), ("p2", "at the bound", at("11:00:00")), ("p3", "late", at("11:00:01")),
         ("p4", "before", at("09:59:59")), ("p5", "twice", at("10:01:00")), ("p6", "twice", at("10:02:00")), (None, "null payment", at("10:05:00")),
         ("p9", None, at("10:05:00"))],
        [("p7", "paid later batch", at("10:59:00"))],
        [("p8", "unknown", at("00:00:00", 3))],
    ])
    query = unpaid.run(orders, payments, f"{tmp_path}/out", f"{tmp_path}/checkpoint", trigger=None, **BOUNDS)
    query.awaitTermination()
    late = ["before", "late", "never", "null payment", "other"]
    assert found(spark, tmp_path) == late  # the last two are still open
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert states[-1] < max(states)  # what the watermark has passed is gone

    # time goes on: open orders are closed, none is passed on again, late rows change nothing
    files(spark, f"{tmp_path}/orders", ORDER, [[("next", at("00:00:00", 9))], [("too late", at("10:00:00"))]])
    files(spark, f"{tmp_path}/payments", PAYMENT, [[("p10", "next", at("00:00:00", 9))], [("p11", "never", at("10:30:00"))]])
    unpaid.run(orders, payments, f"{tmp_path}/out", f"{tmp_path}/checkpoint", trigger=None, **BOUNDS).awaitTermination()
    assert found(spark, tmp_path) == sorted([*late, "clock", "open"])


def test_slower_stream_holds_the_clock(spark, tmp_path):
    """Without payments since, an order cannot be called unpaid."""
    orders = files(spark, f"{tmp_path}/orders", ORDER, [[("a", at("10:00:00"))], [("b", at("10:00:00", 9))]])
    payments = files(spark, f"{tmp_path}/payments", PAYMENT, [[("p", "x", at("10:00:00"))]])
    unpaid.run(orders, payments, f"{tmp_path}/out", f"{tmp_path}/checkpoint", trigger=None, **BOUNDS).awaitTermination()
    assert found(spark, tmp_path) == []


def test_plan_is_a_keyed_join_without_python(spark, tmp_path, capsys):
    orders = files(spark, f"{tmp_path}/orders", ORDER, [[("a", at("10:00:00"))]])
    payments = files(spark, f"{tmp_path}/payments", PAYMENT, [[("p", "a", at("10:00:00"))]])
    unpaid.unpaid_orders(orders, payments, **BOUNDS).explain()
    plan = capsys.readouterr().out
    assert "StreamingSymmetricHashJoin" in plan and "Python" not in plan


@pytest.mark.parametrize("side", ["orders", "payments"])
def test_empty_streams(spark, tmp_path, side):
    rows = {"orders": (ORDER, [("a", at("10:00:00"))]), "payments": (PAYMENT, [("p", "a", at("10:00:00"))])}
    given = {name: files(spark, f"{tmp_path}/{name}", schema, [[] if name == side else data]) for name, (schema, data) in rows.items()}
    unpaid.run(given["orders"], given["payments"], f"{tmp_path}/out", f"{tmp_path}/checkpoint", trigger=None, **BOUNDS).awaitTermination()
    assert found(spark, tmp_path) == []
