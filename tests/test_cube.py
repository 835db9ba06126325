"""Reports from kept aggregates against the same reports from the orders."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from souk.operators import dashboard
from souk.plans import cube
from souk.sinks.versioned import current

SCHEMA = "customer_id LONG, city STRING, category STRING, status STRING, total_amount DECIMAL(12,2), timestamp TIMESTAMP"
FILTERS = [
    {}, {"city": "A"}, {"category": "x"}, {"city": "A", "category": "x"}, {"date_from": "2024-01-20"}, {"date_to": "2024-02-03"},
    {"date_from": "2024-01-31", "date_to": "2024-02-01"}, {"date_to": "2024-02-03", "inclusive_end": True},
    {"city": "B", "date_from": "2024-01-05", "date_to": "2024-03-01"}, {"category": "y", "date_from": "2024-02-02"},
    {"city": "A", "category": "y", "date_from": "2024-01-02", "date_to": "2024-02-28", "inclusive_end": True}, {"city": "nowhere"},
]


def orders(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA.replace("timestamp TIMESTAMP", "t STRING"))
    return df.withColumn("timestamp", F.col("t").cast("timestamp")).drop("t")


@pytest.fixture(scope="module", params=[512, 1], ids=["lists", "bitmaps"])
def kept(spark, tmp_path_factory, request):
    """Three deltas, one of them twice: new orders, changed ones and some that go altogether."""
    root = f"file://{tmp_path_factory.mktemp('cube')}/tables"
    rng, live = random.Random(10), []
    cube.SPARSE = request.param
    for step in range(3):
        new = [
            (rng.choice([None, *range(60)]) if step else rng.randrange(30), rng.choice(["A", "B", None]), rng.choice(["x", "y", None]), "placed",
             rng.choice([None, Decimal(rng.randrange(1, 500))]),
             rng.choice([None, f"2024-0{rng.randrange(1, 4)}-{rng.randrange(1, 28):02d} {rng.choice(['00:00:00', '13:30:00'])}"]))
            for _ in range(60)
        ]
        rng.shuffle(live)
        changed, gone, live = live[:15], live[15:20] if step == 1 else [], live[15:] if step != 1 else live[15:15] + live[20:]
        after = [(*r[:3], "cancelled", *r[4:]) for r in changed]
        live = live + after + new
        for _ in range(2 if step == 1 else 1):
            cube.add_orders(root, f"delta {step}", orders(spark, new + after), orders(spark, changed + gone) if changed + gone else None)
            cube.add_customers(orders(spark, new + gone), root, f"delta {step}")
        everyone = [*(everyone if step else []), *new]  # bitmaps only grow
    return root, orders(spark, live).cache(), orders(spark, everyone).cache()


def rows_of(df):
    return sorted(map(str, df.select(*[F.col(c).cast("string").alias(c) for c in sorted(df.columns)]).collect()))


@pytest.mark.parametrize("filters", FILTERS, ids=str)
def test_reports(spark, kept, filters):
    root, live, everyone = kept
    for name in ("revenue_by_city", "category_sales", "order_status", "monthly_revenue"):
        expected = getattr(dashboard, name)(live, **filters)
        found = getattr(cube, name)(spark, root, **filters)
        money = [c for c in expected.columns if c in ("revenue", "sales")]
        same = lambda df: rows_of(df.withColumns({c: F.col(c).cast("decimal(24,2)") for c in money}))
        assert same(found) == same(expected), name
    one = dashboard.summary(live, **filters).drop("total_customers")
    assert rows_of(cube.summary(spark, root, **filters).drop("total_customers")) == rows_of(one)
    people = dashboard.summary(everyone, **filters).select("total_customers")
    assert rows_of(cube.summary(spark, root, **filters).select("total_customers")) == rows_of(people)


def test_customers_per_day(spark, kept):
    root, _, everyone = kept
    expected = everyone.groupBy(F.to_date("timestamp").alias("day")).agg(F.count_distinct("customer_id").alias("customers"))
    assert rows_of(cube.distinct_customers(spark, root, ["day"])) == rows_of(expected.where("customers > 0"))


def test_numbers_are_dense_and_stay(spark, tmp_path):
    root = f"file://{tmp_path}/tables"
    day = [("A", "x", "placed", Decimal(1), "2024-01-01 00:00:00")]
    seen = {}
    for step, ids in enumerate((range(100), range(50, 400), range(400))):
        cube.add_customers(orders(spark, [(i, *day[0]) for i in ids]), root, f"delta {step}")
        numbers = {r.customer_id: r.number for r in cube.read_table(spark, cube.CUSTOMER_NUMBERS, root).collect()}
        assert len(set(numbers.values())) == len(numbers) and min(numbers.values()) >= 1
        assert seen.items() <= numbers.items()
        seen = numbers
    assert len(seen) == 400 and max(seen.values()) < 16 * 50


def test_report_reads_the_smallest_level_and_its_months(spark, kept):
    root = kept[0]
    assert cube.level_for(["status"]) == "status" and cube.level_for(["city"]) == "city-category"
    assert cube.level_for(["city", "day"]) == "day-city" and cube.level_for(["status", "city"]) == "all"
    read = cube.figures(spark, root, ["city"], date_from="2024-02-01", date_to="2024-02-10").inputFiles()
    assert {f.split("part=")[1].split("/")[0] for f in read} == {"day-city_2024-02"}
    with pytest.raises(ValueError, match="whole days"):
        cube.figures(spark, root, ["city"], date_from="2024-02-01 10:00:00")


def test_delta_rewrites_its_months_only(spark, kept):
    root = kept[0]
    before = current(spark, cube.SALES_CUBE, root)[1]["parts"]
    cube.add_orders(root, "one more", orders(spark, [(1, "A", "x", "placed", Decimal(5), "2024-02-02 10:00:00")]))
    after = current(spark, cube.SALES_CUBE, root)[1]["parts"]
    changed = {n.split("_")[-1] for n in after if after[n] != before.get(n)}
    assert changed == {"2024-02", "all"}
