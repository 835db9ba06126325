"""Dashboard figures from kept aggregates instead of the orders.

The cube holds counts and sums per day, city, category and status and for smaller sets of these
(:data:`LEVELS`); a report is answered from the smallest level that has the columns it groups and filters by.
Distinct customers cannot be added up: they are sets of dense customer numbers per day, city and category, which are
united as bitmaps. A set of few numbers is stored as they are, a larger one as a bitmap. Both are kept by deltas;
an order that changes is taken out as it was and put in as it is (sets of customers only grow: they count the
customers of all orders, whatever their status).

Rows at midnight sharp are cells of their own, as the filters compare an end date with midnight.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk.functions.money import TOTAL, ratio
from souk.sinks.versioned import current, merge_version
from souk.sources.schemas import KeyPartition, Table, TimePartition, key_bucket
from souk.sources.tables import read_folders, read_table

TS = "timestamp"
DIMENSIONS = ("day", "at_midnight", "city", "category", "status")
DAY = ("day", "at_midnight")
# from small to large: the first one that has all columns asked for is read
LEVELS = {
    "status": ("status",),
    "city-category": ("city", "category"),
    "day": DAY,
    "day-category": (*DAY, "category"),
    "day-city": (*DAY, "city"),
    "day-city-category": (*DAY, "city", "category"),
    "all": DIMENSIONS,
}
MEASURES = ("orders", "priced", "revenue")
SPARSE = 512  # numbers of a segment that take as much room as its bitmap

SALES_CUBE = Table(
    "gold.sales_cube",
    "level STRING, day DATE, at_midnight BOOLEAN, city STRING, category STRING, status STRING, "
    "orders LONG, priced LONG, revenue DECIMAL(24,2)",
    keys=("level", *DIMENSIONS),
    partition=KeyPartition("part", "concat_ws('_', level, coalesce(date_format(day, 'yyyy-MM'), 'all'))", "STRING"),
    key_fixes_partition=True,
)
CUSTOMER_NUMBERS = Table(
    "gold.customer_numbers",
    "customer_id STRING, number LONG",
    keys=("customer_id",),
    partition=key_bucket("customer_id", buckets=16),
    key_fixes_partition=True,
)
CUSTOMER_BITMAPS = Table(
    "gold.customer_bitmaps",
    "day DATE, at_midnight BOOLEAN, city STRING, category STRING, segment LONG, places ARRAY<BIGINT>, bits BINARY",
    keys=(*DAY, "city", "category", "segment"),
    partition=TimePartition("bitmap_month", "day", "month"),
    key_fixes_partition=True,
)


def _dated(orders: DataFrame) -> DataFrame:
    return orders.withColumns({"day": F.to_date(TS), "at_midnight": F.col(TS) == F.date_trunc("day", TS)})


def _level_of(grouping: Column) -> Column:
    """The name of a grouping set, from the bits of the columns that it leaves out."""
    out = F.lit(None).cast("string")
    for name, kept in LEVELS.items():
        bits = sum(1 << (len(DIMENSIONS) - 1 - i) for i, d in enumerate(DIMENSIONS) if d not in kept)
        out = F.when(grouping == bits, name).otherwise(out)
    return out


def cells(orders: DataFrame, sign: int = 1) -> DataFrame:
    """All levels from one scan of orders with ``city, category, status, total_amount, timestamp``."""
    rows = _dated(orders).select(*DIMENSIONS, "total_amount")
    sets = [[F.col(c) for c in kept] for kept in LEVELS.values()]
    grouped = rows.groupingSets(sets, *DIMENSIONS).agg(
        F.grouping_id().alias("_set"),
        (F.count(F.lit(1)) * sign).alias("orders"),
        (F.count("total_amount") * sign).alias("priced"),
        (F.coalesce(F.sum("total_amount"), F.lit(0)) * sign).cast("decimal(24,2)").alias("revenue"),
    )
    return grouped.withColumn("level", _level_of(F.col("_set"))).drop("_set")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*SALES_CUBE.keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def add_orders(root: str, batch: str, added: DataFrame | None = None, removed: DataFrame | None = None) -> None:
    """Bring a delta into the cube: orders that are new or new in their present form, and those whose
    former form no longer counts. Only the months it touches are rewritten; a repeated ``batch`` does nothing."""
    parts = [cells(rows, sign) for rows, sign in ((added, 1), (removed, -1)) if rows is not None]
    delta = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    merge_version(
        _summed(delta), SALES_CUBE, root,
        lambda stored, new: _summed(stored.unionByName(new)).where("orders <> 0"), mark=batch,
    )


def level_for(columns: Sequence[str]) -> str:
    return next(name for name, kept in LEVELS.items() if set(columns) <= set(kept))


def _midnight(value: str | date) -> date:
    moment = datetime.fromisoformat(str(value))
    if moment.time() != datetime.min.time():
        raise ValueError("kept figures are by day: a filter needs whole days")
    return moment.date()


def _wanted(city=None, category=None, date_from=None, date_to=None, inclusive_end=False) -> tuple[list[Column], list[str], list]:
    """Conditions, the columns they need, and the first and last month (None: open)."""
    wanted, columns, months = [], [], [None, None]
    for name, value in (("city", city), ("category", category)):
        if value:
            wanted.append(F.col(name) == value)
            columns.append(name)
    if date_from:
        first = _midnight(date_from)
        wanted.append(F.col("day") >= F.lit(first))
        months[0] = first.replace(day=1)
    if date_to:
        last = _midnight(date_to)
        whole = F.col("day") <= F.lit(last) if inclusive_end else F.col("day") < F.lit(last)
        wanted.append(whole | ((F.col("day") == F.lit(last)) & F.col("at_midnight")))
        months[1] = last.replace(day=1)
    return wanted, columns + (list(DAY) if date_from or date_to else []), months


def figures(spark: SparkSession, root: str, by: Sequence[str] = (), **filters) -> DataFrame:
    """``orders, priced, revenue`` grouped by some dimensions, with the filters of the dashboard."""
    wanted, columns, months = _wanted(**filters)
    level = level_for([*by, *columns])
    first, last = (f"part={level}_{month:%Y-%m}" if month else None for month in months)
    _, content = current(spark, SALES_CUBE, root)
    # only the folders of this level and of these months are listed
    parts = {
        n: v for n, v in content["parts"].items()
        if n.startswith(f"part={level}_") and (not first or n >= first) and (not last or n <= last)
    }
    rows = read_folders(spark, SALES_CUBE, root, parts)
    for condition in wanted:
        rows = rows.where(condition)
    return rows.groupBy(*by).agg(*[F.sum(m).alias(m) for m in MEASURES])


def _amount() -> Column:
    """Revenue, missing where no order has an amount."""
    return F.when(F.col("priced") > 0, F.col("revenue"))


def revenue_by_city(spark: SparkSession, root: str, **filters) -> DataFrame:
    return figures(spark, root, ["city"], **filters).select("city", _amount().alias("revenue"))


def category_sales(spark: SparkSession, root: str, **filters) -> DataFrame:
    return figures(spark, root, ["category"], **filters).select("category", _amount().alias("sales"))


def order_status(spark: SparkSession, root: str, **filters) -> DataFrame:
    return figures(spark, root, ["status"], **filters).select("status", F.col("orders").alias("count"))


def monthly_revenue(spark: SparkSession, root: str, **filters) -> DataFrame:
    days = figures(spark, root, ["day"], **filters)
    months = days.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(*[F.sum(m).alias(m) for m in MEASURES])
    return months.select("month", _amount().alias("revenue"))


# --- distinct customers -----------------------------------------------------------------------------


def _numbered(stored: DataFrame, new: DataFrame) -> DataFrame:
    """New customers get the next numbers of their bucket; numbers of different buckets interleave."""
    bucket, buckets = CUSTOMER_NUMBERS.partition.name, 16
    last = stored.groupBy(bucket).agg(F.max("number").alias("_last"))
    unseen = new.join(stored.select("customer_id"), "customer_id", "left_anti").join(last, bucket, "left")
    step = F.row_number().over(Window.partitionBy(bucket).orderBy("customer_id")) * buckets
    first = F.coalesce(F.col("_last"), F.col(bucket) + 1 - buckets)
    return stored.unionByName(unseen.withColumn("number", (first + step).cast("long")).select(*stored.columns))


def add_customers(orders: DataFrame, root: str, batch: str) -> None:
    """Enter the customers of new orders into the bitmaps of their days; a repeated ``batch`` does nothing."""
    ids = orders.where("customer_id is not null").select(F.col("customer_id").cast("string").alias("customer_id")).distinct()
    merge_version(ids.withColumn("number", F.lit(None).cast("long")), CUSTOMER_NUMBERS, root, _numbered, mark=batch)
    numbers = read_table(orders.sparkSession, CUSTOMER_NUMBERS, root).select("customer_id", "number")
    seen = _dated(orders).withColumn("customer_id", F.col("customer_id").cast("string")).join(numbers, "customer_id")
    places = seen.withColumns(
        {"segment": F.bitmap_bucket_number("number"), "place": F.bitmap_bit_position("number")}
    )
    merge_version(_packed(places), CUSTOMER_BITMAPS, root, _united, mark=batch)


def _packed(places: DataFrame) -> DataFrame:
    """Sets of places per cell and segment (at most a bitmap's 32,768), as lists or bitmaps."""
    keys = CUSTOMER_BITMAPS.keys
    sets = places.groupBy(*keys).agg(F.array_sort(F.collect_set("place")).alias("places"))
    few = sets.where(F.size("places") <= SPARSE).withColumn("bits", F.lit(None).cast("binary"))
    many = sets.where(F.size("places") > SPARSE).select(*keys, F.explode("places").alias("place"))
    maps = many.groupBy(*keys).agg(F.bitmap_construct_agg("place").alias("bits"))
    return few.unionByName(maps.withColumn("places", F.lit(None).cast("array<bigint>")))


def _united(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Both sets per cell; one with a bitmap may keep a list of a few more beside it."""
    keys = CUSTOMER_BITMAPS.keys
    rows = stored.unionByName(new).select(*keys, "places", "bits")
    packed = _packed(rows.where("places is not null").select(*keys, F.explode("places").alias("place")))
    maps = rows.where("bits is not null").unionByName(packed.where("bits is not null")).groupBy(*keys).agg(
        F.bitmap_or_agg("bits").alias("bits")
    )
    return packed.where("bits is null").unionByName(maps.withColumn("places", F.lit(None).cast("array<bigint>")))


def distinct_customers(spark: SparkSession, root: str, by: Sequence[str] = (), **filters) -> DataFrame:
    """Customers with an order, exactly, grouped by any of day, city and category."""
    wanted, _, months = _wanted(**filters)
    rows = read_table(spark, CUSTOMER_BITMAPS, root)
    for month, condition in zip(months, (F.col("bitmap_month") >= F.lit(months[0]), F.col("bitmap_month") <= F.lit(months[1]))):
        rows = rows.where(condition) if month else rows
    for condition in wanted:
        rows = rows.where(condition)
    few = rows.where("places is not null").select(*by, "segment", F.explode("places").alias("place"))
    maps = few.groupBy(*by, "segment").agg(F.bitmap_construct_agg("place").alias("bits"))
    maps = maps.unionByName(rows.where("bits is not null").select(*by, "segment", "bits"))
    united = maps.groupBy(*by, "segment").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("_n"))
    return united.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("customers"))


def summary(spark: SparkSession, root: str, **filters) -> DataFrame:
    """The headline figures in one row."""
    totals = figures(spark, root, **filters).select(
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        F.coalesce("revenue", F.lit(0)).cast(TOTAL).alias("total_revenue"),
        F.coalesce(ratio(F.col("revenue"), F.col("priced"), "decimal(12,2)"), F.lit(0)).cast("decimal(12,2)").alias("average_order_value"),
        F.lit(1).alias("_one"),
    )
    people = distinct_customers(spark, root, **filters).select(F.col("customers").alias("total_customers"), F.lit(1).alias("_one"))
    return totals.join(people, "_one").select("total_orders", "total_revenue", "total_customers", "average_order_value")
