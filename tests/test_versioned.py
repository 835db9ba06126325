"""Changes that appear at once, and KPI tables kept by deltas, against full recomputations."""

import random

import pytest
from pyspark.sql import functions as F
from test_writers import FIRST, SECOND, hours

from souk.functions.filters import not_cancelled
from souk.operators import gold
from souk.operators.medallion import current_deliveries
from souk.plans import incremental
from souk.sinks import versioned
from souk.sinks.versioned import current, merge_version, replace_version
from souk.sources.schemas import CUSTOMER_METRICS, DELAYED_SHIPMENTS, HOURLY_REVENUE
from souk.sources.tables import read_partitions, read_table


def content(rows):
    return sorted((str(r.hour_bucket), r.product_category or "-", float(r.total_revenue)) for r in rows.collect())


def test_reader_sees_all_of_a_refresh_or_nothing(spark, root):
    """Queries that began before a refresh of several days give the old rows, also those not yet run."""
    replace_version(hours(spark, FIRST), HOURLY_REVENUE, root)
    before = read_table(spark, HOURLY_REVENUE, root)
    old = content(before)
    seen = []
    original = versioned.Versions.commit

    def commit(self, number, what):
        seen.append(content(read_table(spark, HOURLY_REVENUE, root)))  # all files are written, nothing counts yet
        original(self, number, what)

    versioned.Versions.commit = commit
    try:
        replace_version(hours(spark, [("2024-01-01 12:00", "B", "4", 1), ("2024-01-03 12:00", "B", "5", 1)]), HOURLY_REVENUE, root)
    finally:
        versioned.Versions.commit = original
    assert seen == [old] and content(before) == old
    assert content(read_table(spark, HOURLY_REVENUE, root)) == [("2024-01-01 12:00:00", "B", 4.0), ("2024-01-03 12:00:00", "B", 5.0)]


def test_failed_refresh_leaves_the_version_before(spark, root):
    replace_version(hours(spark, FIRST), HOURLY_REVENUE, root)
    before = content(read_table(spark, HOURLY_REVENUE, root))
    failing = hours(spark, SECOND).withColumn("order_count", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        replace_version(failing, HOURLY_REVENUE, root)
    assert content(read_table(spark, HOURLY_REVENUE, root)) == before and current(spark, HOURLY_REVENUE, root)[0] == 1
    replace_version(hours(spark, SECOND), HOURLY_REVENUE, root)  # over what the failed job left behind
    assert len(content(read_table(spark, HOURLY_REVENUE, root))) == 2


def test_range_keeps_older_hours_and_unknown_times(spark, root):
    replace_version(hours(spark, [*FIRST, (None, "C", "7", 1)]), HOURLY_REVENUE, root)
    since = F.lit("2024-01-01 11:00").cast("timestamp")
    replace_version(hours(spark, [("2024-01-01 12:00", "B", "4", 1)]), HOURLY_REVENUE, root, since)
    kept = [("2024-01-01 10:00:00", "A", 1.0), ("2024-01-01 12:00:00", "B", 4.0), ("None", "C", 7.0)]
    assert content(read_table(spark, HOURLY_REVENUE, root)) == kept
    assert content(read_partitions(spark, HOURLY_REVENUE, root, [None])) == kept[2:]
    replace_version(hours(spark, FIRST).limit(0), HOURLY_REVENUE, root)
    assert content(read_table(spark, HOURLY_REVENUE, root)) == []


def test_merge_rewrites_touched_partitions_once(spark, root, tmp_path):
    replace_version(hours(spark, FIRST), HOURLY_REVENUE, root)
    together = lambda stored, new: stored.unionByName(new).groupBy("hour_bucket", "product_category").agg(
        *[F.sum(c).alias(c) for c in ("total_revenue", "order_count")])
    for _ in range(2):  # the mark tells that it was applied
        merge_version(hours(spark, SECOND), HOURLY_REVENUE, root, together, mark="second")
    assert content(read_table(spark, HOURLY_REVENUE, root)) == [
        ("2024-01-01 10:00:00", "A", 1.0), ("2024-01-01 11:00:00", "-", 22.0), ("2024-01-01 12:00:00", "B", 4.0), ("2024-01-02 10:00:00", "A", 3.0),
    ]
    _, last = current(spark, HOURLY_REVENUE, root)
    assert last["parts"] == {"bucket_date=2024-01-01": 2, "bucket_date=2024-01-02": 1}
    for n in range(5):  # old versions go, what the last ones use stays
        merge_version(hours(spark, SECOND[1:]), HOURLY_REVENUE, root, together, mark=n)
    folder = tmp_path / "tables/gold/hourly_revenue"
    assert len(list((folder / "_versions").glob("*.json"))) == versioned.KEEP
    assert (folder / "version=1/bucket_date=2024-01-02").exists() and not (folder / "version=2/bucket_date=2024-01-01").exists()
    assert len(content(read_table(spark, HOURLY_REVENUE, root))) == 4


def deliveries(spark, rows):
    df = spark.createDataFrame(rows, "delivery_id STRING, delivery_status STRING, city STRING, estimated_days INT, actual_days INT, t STRING")
    return df.withColumn("event_time", F.col("t").cast("timestamp")).drop("t")


def shipments(df):
    return sorted((str(r.date_bucket), str(r.city), r.delayed_count, r.total_shipments, float(r.delay_rate)) for r in df.collect())


def test_late_shipments_by_deltas(spark, root, monkeypatch):
    """Deliveries that move between days and cities, events out of order, a repeated delta, an interrupted refresh."""
    rng, everything = random.Random(8), []
    for step in range(5):
        rows = [
            (f"d{rng.randrange(40)}", rng.choice(["shipped", "delivered"]), rng.choice(["A", "B", None]), rng.choice([3, None]),
             rng.choice([None, 2, 5]), f"2024-0{rng.randrange(1, 4)}-{rng.randrange(10, 13)} {rng.randrange(24):02d}:{len(everything) % 60:02d}:{step:02d}")
            for _ in range(25)
        ]
        rows = [(*r[:5], r[5][:-2] + f"{i:02d}") for i, r in enumerate(rows)]  # no two events at one time
        everything += rows
        for _ in range(2 if step == 3 else 1):
            incremental.add_deliveries(deliveries(spark, rows), root, f"delta {step}")
        if step != 1:  # one refresh is left out and made up by the next
            incremental.refresh_delayed_shipments(spark, root)
            expected = shipments(gold.delayed_shipments(current_deliveries(deliveries(spark, everything))))
            assert shipments(read_table(spark, DELAYED_SHIPMENTS, root)) == expected
    number = current(spark, DELAYED_SHIPMENTS, root)[0]
    incremental.refresh_delayed_shipments(spark, root)
    assert current(spark, DELAYED_SHIPMENTS, root)[0] == number  # nothing changed, nothing is written
    for k in range(versioned.KEEP + 1):  # too far behind: counted anew
        everything.append((f"x{k}", "shipped", "A", 1, 2, f"2024-05-01 00:00:0{k}"))
        incremental.add_deliveries(deliveries(spark, everything[-1:]), root, f"late {k}")
    incremental.refresh_delayed_shipments(spark, root)
    expected = shipments(gold.delayed_shipments(current_deliveries(deliveries(spark, everything))))
    assert shipments(read_table(spark, DELAYED_SHIPMENTS, root)) == expected


def test_delta_reads_only_the_buckets_it_touches(spark, root):
    first = [(f"d{i}", "shipped", "A", 1, 2, "2024-01-01 00:00:00") for i in range(200)]
    incremental.add_deliveries(deliveries(spark, first), root, "a")
    number = current(spark, incremental.DELIVERY_STATE, root)[0]
    incremental.add_deliveries(deliveries(spark, [("d7", "delivered", "A", 1, 2, "2024-01-02 00:00:00")]), root, "b")
    changes = versioned.signed_changes(spark, incremental.DELIVERY_STATE, root, number)
    assert len({f.split("key_bucket=")[1].split("/")[0] for f in changes.inputFiles()}) == 1
    assert changes.count() < 200


ORDER = "user_id STRING, product_category STRING, payment_method STRING, total_amount DECIMAL(12,2), order_status STRING, t STRING"


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDER).withColumn("event_time", F.col("t").cast("timestamp")).drop("t")


def test_customers_by_deltas(spark, root):
    """Two deltas and a cancellation that takes first days, favourites and whole customers away."""
    from decimal import Decimal

    rng, live = random.Random(9), []
    for step in range(3):
        new = [
            (f"u{rng.randrange(25)}", rng.choice(["A", "B", "C", None]), rng.choice(["UPI", "COD"]), rng.choice([None, Decimal(rng.randrange(1, 99))]),
             "placed", f"2024-01-{rng.randrange(1, 28):02d} 10:00:00")
            for _ in range(40)
        ]
        gone = [live.pop(rng.randrange(len(live))) for _ in range(30)] if step else []
        gone += [r for r in live if r[0] == "u3"] if step == 2 else []
        live = [r for r in live if not (step == 2 and r[0] == "u3")] + new
        for _ in range(2):
            incremental.add_orders(root, f"delta {step}", orders(spark, new), orders(spark, gone) if gone else None)
            incremental.refresh_customer_metrics(spark, root)
        expected = gold.customer_metrics(not_cancelled(orders(spark, live)), "2024-02-20").drop("refreshed_at")
        found = incremental.customer_metrics(spark, root, "2024-02-20").select(*expected.columns)
        fill = lambda df: sorted(map(str, df.fillna({"total_spend": 0, "avg_order_value": 0}).withColumns(
            {c: F.col(c).cast("double") for c in ("total_spend", "avg_order_value")}).collect()))
        assert fill(found) == fill(expected)
    assert current(spark, CUSTOMER_METRICS, root)[0] == 3
