"""Data-quality checks. All checks of a table come from one aggregate over it."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.grouping import always_one_row
from souk.functions.money import RATE
from souk.functions.times import AsOf, at, on_day, trailing
from souk.operators.links import paid_order_ids
from souk.sources.schemas import EVENT_TYPES

# fixed values: periods and limits
CHECK_PERIOD = "6 hours"
FRESH_PERIOD = "30 minutes"
SUMMARY_PERIOD = "7 hours"
WARN_BELOW = "0.05"
FAILURE_RATE_WARN_PCT = 30
FAILURE_RATE_FAIL_PCT = 50
MAX_DAILY_FAIL_PCT = 30

Check = tuple[str, Column, Column]  # name, records checked, records failed
LOG = ("run_id", "layer", "table_name", "check_name", "status", "records_checked", "records_failed")


class QualityFailure(ValueError):
    """A check ended with status ``failed``."""


def new_run_id() -> str:
    return uuid.uuid4().hex[:8]


def graded(checked: Column, failed: Column) -> Column:
    """passed without failures, warning below 5 %, else failed."""
    share = F.try_divide(
        failed.cast("decimal(20,0)"), F.greatest(checked, F.lit(1)).cast("decimal(20,0)")
    )
    return (
        F.when(failed == 0, "passed")
        .when(share < F.lit(WARN_BELOW).cast("decimal(3,2)"), "warning")
        .otherwise("failed")
    )


def check_log(
    totals: DataFrame, layer: str, table: str, checks: list[tuple[str, str, str, Column]], run_id: str | None
) -> DataFrame:
    """One row per check from a one-row frame of counts.

    ``checks``: name, count column of records checked, of records failed, status.
    """
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            status.alias("status"),
            F.col(checked).cast("long").alias("records_checked"),
            (F.col(failed) if failed else F.lit(0)).cast("long").alias("records_failed"),
        )
        for name, checked, failed, status in checks
    ]
    return totals.select(
        F.lit(run_id or new_run_id()).alias("run_id"),
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        F.inline(F.array(*rows)),
    ).select(*LOG)


def run_checks(
    df: DataFrame, layer: str, table: str, checks: list[Check], run_id: str | None = None
) -> DataFrame:
    """Any list of counted checks over ``df`` in a single pass."""
    counts, rows = [], []
    for i, (name, checked, failed) in enumerate(checks):
        counts += [
            F.coalesce(checked, F.lit(0)).alias(f"c{i}"),
            F.coalesce(failed, F.lit(0)).alias(f"f{i}"),
        ]
        rows.append((name, f"c{i}", f"f{i}", graded(F.col(f"c{i}"), F.col(f"f{i}"))))
    return check_log(df.agg(*counts), layer, table, rows, run_id)


def bronze_checks(raw: DataFrame, as_of: AsOf = None, run_id: str | None = None) -> DataFrame:
    """Ids, types and known types of the last six hours, and freshness of the last half hour."""
    recent = raw.filter(trailing(raw, "ingested_at", CHECK_PERIOD, as_of))
    fresh = trailing(raw, "ingested_at", FRESH_PERIOD, as_of)
    totals = recent.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_id").isNull()).alias("no_id"),
        F.count_if(F.col("event_type").isNull()).alias("no_type"),
        F.count_if(~F.col("event_type").isin(*EVENT_TYPES)).alias("bad_type"),
        F.count_if(fresh).alias("fresh"),
    )
    return check_log(
        totals,
        "bronze",
        "raw_events",
        [
            ("no_null_event_ids", "n", "no_id", graded(F.col("n"), F.col("no_id"))),
            ("no_null_event_types", "n", "no_type", graded(F.col("n"), F.col("no_type"))),
            ("valid_event_types", "n", "bad_type", graded(F.col("n"), F.col("bad_type"))),
            _freshness("fresh"),
        ],
        run_id,
    )


def freshness_check(raw: DataFrame, as_of: AsOf = None, run_id: str | None = None) -> DataFrame:
    """Only the freshness check: a warning if nothing arrived in the last half hour."""
    totals = raw.filter(trailing(raw, "ingested_at", FRESH_PERIOD, as_of)).agg(
        F.count(F.lit(1)).alias("fresh")
    )
    return check_log(totals, "bronze", "raw_events", [_freshness("fresh")], run_id)


def _freshness(column: str):
    status = F.when(F.col(column) > 0, "passed").otherwise("warning")
    return ("data_freshness_30min", column, "", status)


def silver_order_checks(orders: DataFrame, as_of: AsOf = None, run_id: str | None = None) -> DataFrame:
    """Users, amounts, quantities, future times and duplicate ids of the last six hours."""
    now = at(orders, "event_time", as_of)
    bad = {
        "no_null_user_id": F.col("user_id").isNull(),
        "no_negative_amounts": F.col("total_amount") < 0,
        "valid_quantity": F.col("quantity") <= 0,
        "no_future_timestamps": F.col("event_time") > now,
    }
    # per id first, so that duplicates are counted without a second scan
    per_id = (
        orders.filter(trailing(orders, "processed_at", CHECK_PERIOD, as_of))
        .groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(name) for name, c in bad.items()])
    )
    totals = per_id.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *bad)],
        F.count("order_id").alias("ids"),
        F.count_if(F.col("n") > 1).alias("no_duplicate_order_ids"),
    )
    rows = [(name, "n", name, graded(F.col("n"), F.col(name))) for name in bad]
    twice = "no_duplicate_order_ids"
    rows.append((twice, "ids", twice, graded(F.col("ids"), F.col(twice))))
    return check_log(totals, "silver", "orders", rows, run_id)


def payment_failure_check(payments: DataFrame, as_of: AsOf = None, run_id: str | None = None) -> DataFrame:
    """Failure rate of the last six hours: below 30 % passed, below 50 % warning."""
    totals = payments.filter(trailing(payments, "processed_at", CHECK_PERIOD, as_of)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("payment_status") == "failed").alias("failures"),
    )
    scaled = F.col("failures") * 100  # compared with limit * n: no division by zero
    status = (
        F.when((F.col("n") == 0) | (scaled < F.col("n") * FAILURE_RATE_WARN_PCT), "passed")
        .when(scaled < F.col("n") * FAILURE_RATE_FAIL_PCT, "warning")
        .otherwise("failed")
    )
    return check_log(
        totals, "silver", "payments", [("payment_failure_rate_check", "n", "failures", status)], run_id
    )


def stamped(log: DataFrame, run_at: AsOf = None) -> DataFrame:
    """Check rows with the time of the run."""
    when = F.current_timestamp() if run_at is None else F.lit(str(run_at)).cast("timestamp")
    return log.withColumn("run_at", when)


def dq_summary(log: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Checks per status in the last seven hours of the log."""
    return (
        log.filter(trailing(log, "run_at", SUMMARY_PERIOD, as_of))
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("check_count"))
        .orderBy("status")
    )


def raise_on_failure(log: DataFrame) -> None:
    """Raise if a check failed; the log has one row per check."""
    failed = log.filter(F.col("status") == "failed").collect()
    if failed:
        text = "; ".join(
            f"{r.table_name}.{r.check_name}: {r.records_failed}/{r.records_checked}" for r in failed
        )
        raise QualityFailure(text)


def daily_quality_report(
    orders: DataFrame, payments: DataFrame, day: str | date | None = None, ts: str = "timestamp"
) -> DataFrame:
    """Counts of bad rows, unmatched orders and the payment failure rate per day, with a status.

    The given day, or every day at once. A failed day gets a row with ``FAILED``.
    """
    order_rows, payment_rows = orders, payments
    if day is not None:
        order_rows = orders.filter(on_day(orders, ts, day))
        payment_rows = payments.filter(on_day(payments, ts, day))
    required = ("order_id", "customer_id", "product_name", "total_amount")
    amounts = ("total_amount", "price", "quantity")
    absent = _any([F.col(c).isNull() for c in required])
    bad = _any([F.coalesce(F.col(c) <= 0, F.lit(False)) for c in amounts])
    per_id = order_rows.groupBy(F.to_date(ts).alias("check_date"), "order_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(absent).alias("absent"),
        F.count_if(bad).alias("bad"),
    )
    looked_up = None if day is None else order_rows
    paid = paid_order_ids(payments, looked_up).withColumn("_paid", F.lit(True))
    checked = (
        per_id.join(paid, "order_id", "left")
        .groupBy("check_date")
        .agg(
            F.sum("absent").alias("null_values"),
            F.sum("bad").alias("negative_amounts"),
            F.count_if(F.col("n") > 1).alias("duplicate_orders"),
            F.coalesce(F.sum(F.when(F.col("_paid").isNull(), F.col("n"))), F.lit(0)).alias(
                "unmatched_payments"
            ),
        )
    )
    rates = payment_rows.groupBy(F.to_date(ts).alias("check_date")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("status") == "failed").alias("_f")
    )
    report = checked.join(rates, "check_date", "full_outer")
    if day is not None:
        report = always_one_row(report, {"check_date": F.lit(str(day)).cast("date")})
    counts = ("null_values", "negative_amounts", "duplicate_orders", "unmatched_payments")
    report = report.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in (*counts, "_n", "_f")}
    )
    rate = F.try_divide((F.col("_f") * 100).cast("decimal(22,0)"), F.col("_n").cast("decimal(20,0)"))
    failed = (
        (F.col("null_values") > 0)
        | (F.col("negative_amounts") > 0)
        | (F.col("duplicate_orders") > 0)
        | (F.col("_f") * 100 > F.col("_n") * MAX_DAILY_FAIL_PCT)
    )
    return report.select(
        "check_date",
        *counts,
        F.coalesce(rate.cast(RATE), F.lit(0)).cast(RATE).alias("payment_fail_rate"),
        F.when(failed, "FAILED").otherwise("PASSED").alias("status"),
    )


def _any(conditions: list[Column]) -> Column:
    first, *rest = conditions
    for c in rest:
        first = first | c
    return first
