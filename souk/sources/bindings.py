"""The given test tables as the tables and messages of the pipeline.

Each view joins only the dimensions whose columns are asked for. Dimension keys are primary keys,
so leaving a join out changes no row. Dimension joins carry no hints: Spark broadcasts a dimension
while its size allows and shuffles (splitting hot keys) beyond that.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.session import run_dir
from souk.sources.schemas import DELIVERIES_TOPIC, ORDERS_TOPIC, PAYMENTS_TOPIC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The events table as a file stream."""
    return _table_stream(spark, sf_dir, "events", max_files)


def with_city(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines (batch or stream), each with the city of its supplier."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )


def _table_stream(
    spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None
) -> DataFrame:
    schema: StructType = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # as a pattern the path may be one file or a folder of files
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


BATCHES = 4
FILE_ROWS = 20_000  # rows of a replayed file, as long as there are fewer files than two per core
REDELIVERY = 1_000_000_000_000  # offset distance of redelivered copies


def replay(
    spark: SparkSession, sf_dir: str, name: str, time: str, late: Column | None = None, again: bool = False
) -> DataFrame:
    """A table as a stream of several micro-batches in the order of ``time``.

    Rows get a ``position`` of their own and ``copy`` = 0. ``late`` marks rows that come with the last
    batch; with ``again`` every row is delivered once more in the batch after its own, as ``copy`` 1.
    """
    rows = table(spark, sf_dir, name).withColumn("position", F.monotonically_increasing_id())
    seconds = F.col(time).cast("timestamp").cast("double")
    shares = [i / BATCHES for i in range(1, BATCHES)]
    edges = rows.select(seconds.alias("t")).approxQuantile("t", shares, 0.001)
    part = sum((F.when(seconds >= edge, 1).otherwise(0) for edge in edges), F.lit(0))
    if late is not None:
        part = F.when(late, BATCHES - 1).otherwise(part)
    rows = rows.withColumn("_part", part)
    # a file is read by one task, so a batch of one file would keep one core busy
    files = min(2 * spark.sparkContext.defaultParallelism, max(1, rows.count() // (BATCHES * FILE_ROWS)))
    folder = run_dir(spark, name)
    for k in range(BATCHES + again):  # files are streamed in the order they were written
        batch = rows.filter(F.col("_part") == k).withColumn("copy", F.lit(0))
        if again:
            batch = batch.unionByName(rows.filter(F.col("_part") == k - 1).withColumn("copy", F.lit(1)))
        batch.drop("_part").repartition(files).write.mode("append").parquet(folder)
    schema = rows.drop("_part").withColumn("copy", F.lit(0)).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def _offset(rows: DataFrame, own: Column) -> Column:
    """The position of a message; redelivered copies come after everything."""
    return own + F.col("copy") * F.lit(REDELIVERY) if "copy" in rows.columns else own


def _choice(selector: Column, labels: list[str]) -> Column:
    """``labels`` by number; the last one for all higher numbers."""
    choice = F.when(selector == 0, labels[0])
    for i, label in enumerate(labels[1:-1], 1):
        choice = choice.when(selector == i, label)
    return choice.otherwise(labels[-1])


def _customer_city(facts: DataFrame, spark: SparkSession, sf_dir: str, need: set[str], key: str) -> DataFrame:
    if need & {"customer_name", "city"}:
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
        facts = facts.join(customer, F.col(key) == F.col("c_custkey"))
    if "city" in need:
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        facts = facts.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return facts


def _pick(facts: DataFrame, columns: dict[str, Column], wanted: Iterable[str]) -> DataFrame:
    return facts.select(*[columns[c].alias(c) for c in wanted])


def orders(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """Flat orders, one row per order."""
    facts = _customer_city(table(spark, sf_dir, "orders"), spark, sf_dir, set(wanted), "o_custkey")
    status = F.col("o_orderstatus")
    columns = {
        "order_id": F.col("o_orderkey").cast("string"),
        "customer_id": F.col("o_custkey").cast("string"),
        "customer_name": F.col("c_name"),
        "product_name": F.lit("basket"),
        "city": F.col("n_name"),
        "category": F.col("o_orderpriority"),
        "quantity": F.lit(1),
        "price": F.col("o_totalprice").cast("decimal(12,2)"),
        "status": F.when(status == "O", "placed").when(status == "P", "processing").otherwise("cancelled"),
        "total_amount": F.col("o_totalprice").cast("decimal(12,2)"),
        "timestamp": F.col("o_orderdate"),
    }
    return _pick(facts, columns, wanted)


def order_lines(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """Flat orders, one row per order line (the product-level view)."""
    need = set(wanted)
    facts = table(spark, sf_dir, "lineitem")
    if need & {"customer_id", "customer_name", "city", "timestamp"}:
        head = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        facts = facts.join(head, F.col("l_orderkey") == F.col("o_orderkey"))
        facts = _customer_city(facts, spark, sf_dir, need, "o_custkey")
    if need & {"product_name", "brand", "category"}:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
        facts = facts.join(part, F.col("l_partkey") == F.col("p_partkey"))
    columns = {
        "order_id": F.col("l_orderkey"),
        "line_no": F.col("l_linenumber"),
        "customer_id": F.col("o_custkey"),
        "customer_name": F.col("c_name"),
        "city": F.col("n_name"),
        "product_id": F.col("l_partkey"),
        "product_name": F.col("p_name"),
        "brand": F.col("p_brand"),
        "category": F.col("p_type"),
        "quantity": F.col("l_quantity").cast("int"),
        "total_amount": F.col("l_extendedprice").cast("decimal(12,2)"),
        "timestamp": F.col("o_orderdate"),
    }
    return _pick(facts, columns, wanted)


def deliveries(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """Flat deliveries, one row per order line."""
    facts = table(spark, sf_dir, "lineitem")
    if "city" in wanted:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        facts = facts.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
            nation, F.col("s_nationkey") == F.col("n_nationkey")
        )
    flag = F.col("l_returnflag")
    columns = {
        "delivery_id": F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
        "order_id": F.col("l_orderkey").cast("string"),
        "line_no": F.col("l_linenumber"),
        "city": F.col("n_name"),
        "status": F.when(flag == "A", "dispatched").when(flag == "N", "in_transit").otherwise("out_for_delivery"),
        "estimated_days": F.col("l_linenumber"),
        "actual_days": F.col("l_quantity").cast("int") % 10,
        "timestamp": F.col("l_shipdate"),
        "event_time": F.col("l_shipdate"),
    }
    return _pick(facts, columns, wanted)


METHODS = ["UPI", "Credit Card", "Debit Card", "Net Banking", "COD"]


def payments(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """Payments from purchase and error events."""
    facts = table(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "error"))
    status = F.when(F.col("event_type") == "purchase", "success").otherwise("failed")
    method = _choice(F.col("user_id") % 5, METHODS)
    columns = {
        "payment_id": F.col("event_id").cast("string"),
        "order_id": F.col("event_id").cast("string"),
        "user_id": F.col("user_id").cast("string"),
        "amount": F.col("value").cast("decimal(12,2)"),
        "method": method,
        "payment_method": method,
        "status": status,
        "payment_status": status,
        "timestamp": F.col("ts"),
        "event_time": F.col("ts"),
        "processed_at": F.col("ts"),
    }
    return _pick(facts, columns, wanted)


CATEGORIES = ["Electronics", "Clothing", "Kitchen", "Beauty"]
CITIES = ["Mumbai", "Delhi", "Pune"]


def event_orders(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """Silver (and flat) orders with a time of day, one per event."""
    return event_orders_from(table(spark, sf_dir, "events"), *wanted)


def event_orders_from(events: DataFrame, *wanted: str) -> DataFrame:
    category = _choice(F.col("event_id") % 4, CATEGORIES)
    status = F.when(F.col("event_type") == "error", "cancelled").otherwise("placed")
    columns = {
        "order_id": F.col("event_id").cast("string"),
        "event_id": F.col("event_id").cast("string"),
        "user_id": F.col("user_id").cast("string"),
        "customer_id": F.col("user_id").cast("string"),
        "product_id": F.concat(F.lit("PROD-"), (F.col("event_id") % 4).cast("string")),
        "product_category": category,
        "product_name": category,
        "payment_method": _choice(F.col("user_id") % 5, METHODS),
        "city": _choice(F.col("user_id") % 3, CITIES),
        "order_status": status,
        "status": status,
        "quantity": (F.col("event_id") % 4).cast("int"),
        "price": F.col("value").cast("decimal(12,2)"),
        "unit_price": F.col("value").cast("decimal(10,2)"),
        "total_amount": F.col("value").cast("decimal(12,2)"),
        "event_time": F.col("ts"),
        "processed_at": F.col("ts"),
        "timestamp": F.col("ts"),
    }
    return _pick(events, columns, wanted)


def raw_events(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """Bronze rows, one per event; type ``click`` stays outside the known types."""
    kind = F.col("event_type")
    columns = {
        "event_id": F.col("event_id").cast("string"),
        "event_type": F.when(kind == "purchase", "order_placed")
        .when(kind == "error", "payment_failed")
        .when(kind == "signup", "payment_success")
        .when(kind == "view", "cart_abandoned")
        .otherwise(kind),
        "user_id": F.col("user_id").cast("string"),
        "raw_payload": F.col("props"),
        "kafka_partition": (F.col("event_id") % 3).cast("int"),
        "kafka_offset": F.col("event_id"),
        "ingested_at": F.col("ts"),
    }
    return _pick(table(spark, sf_dir, "events"), columns, wanted)


def messages(events: DataFrame) -> DataFrame:
    """Events (batch or stream) as JSON messages of the three topics.

    purchase -> order_placed, view -> cart_abandoned, signup -> payment_success,
    error -> payment_failed, click -> order_shipped / order_delivered by turns. Two neighbouring
    ids share a delivery id, so deliveries have several events.
    """
    kind = F.col("event_type")
    text = F.col("event_id").cast("string")
    event_type = (
        F.when(kind == "purchase", "order_placed")
        .when(kind == "view", "cart_abandoned")
        .when(kind == "signup", "payment_success")
        .when(kind == "error", "payment_failed")
        .when(F.col("event_id") % 2 == 0, "order_shipped")
        .otherwise("order_delivered")
    )
    topic = (
        F.when(kind.isin("purchase", "view"), ORDERS_TOPIC)
        .when(kind.isin("signup", "error"), PAYMENTS_TOPIC)
        .otherwise(DELIVERIES_TOPIC)
    )
    user = F.concat(F.lit("USR-"), F.col("user_id").cast("string"))
    common = {
        "event_id": F.concat(F.lit("EVT-"), text),
        "event_type": event_type,
        "timestamp": F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
        "user_id": user,
    }
    method = _choice(F.col("user_id") % 5, METHODS)
    by_kind = {
        "order": {
            "order_id": F.concat(F.lit("ORD-"), text),
            "product_id": F.concat(F.lit("PROD-"), (F.col("event_id") % 4).cast("string")),
            "product_category": _choice(F.col("event_id") % 4, CATEGORIES),
            "quantity": (F.col("event_id") % 4).cast("int"),
            "unit_price": F.col("value"),
            "total_amount": F.col("value"),
            "payment_method": method,
            "city": _choice(F.col("user_id") % 3, CITIES),
        },
        "payment": {
            "payment_id": F.concat(F.lit("PAY-"), text),
            "order_id": F.concat(F.lit("ORD-"), text),
            "amount": F.col("value"),
            "payment_method": method,
            "payment_status": F.when(kind == "signup", "success").otherwise("failed"),
        },
        "delivery": {
            "delivery_id": F.concat(F.lit("DEL-"), F.floor(F.col("event_id") / 2).cast("string")),
            "order_id": F.concat(F.lit("ORD-"), text),
            "delivery_status": F.when(F.col("event_id") % 2 == 0, "shipped").otherwise("delivered"),
            "city": _choice(F.col("user_id") % 3, CITIES),
            "estimated_days": (F.col("event_id") % 5 + 2).cast("int"),
            "actual_days": (F.col("event_id") % 7 + 1).cast("int"),
        },
    }

    def json(kind_fields: dict[str, Column]) -> Column:
        return F.to_json(F.struct(*[c.alias(n) for n, c in {**common, **kind_fields}.items()]))

    value = (
        F.when(topic == ORDERS_TOPIC, json(by_kind["order"]))
        .when(topic == PAYMENTS_TOPIC, json(by_kind["payment"]))
        .otherwise(json(by_kind["delivery"]))
    )
    return events.select(
        user.alias("key"),
        value.alias("value"),
        topic.alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        _offset(events, F.col("event_id")).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def cancel_messages(events: DataFrame) -> DataFrame:
    """Every fifth purchase is cancelled an hour later."""
    text = F.col("event_id").cast("string")
    at = F.col("ts").cast("timestamp") + F.expr("INTERVAL 1 HOUR")
    record = F.struct(
        F.concat(F.lit("CAN-"), text).alias("event_id"),
        F.lit("order_cancelled").alias("event_type"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        F.concat(F.lit("USR-"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("ORD-"), text).alias("order_id"),
    )
    chosen = events.filter((F.col("event_type") == "purchase") & (F.col("event_id") % 5 == 0))
    return chosen.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(record).alias("value"),
        F.lit(ORDERS_TOPIC).alias("topic"),
        F.lit(3).alias("partition"),
        F.col("event_id").alias("offset"),
        at.alias("timestamp"),
    )


def flat_order_messages(order_rows: DataFrame) -> DataFrame:
    """Orders (batch or stream) as flat JSON messages."""
    status = F.col("o_orderstatus")
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.lit("basket").alias("product_name"),
        F.col("o_orderpriority").alias("category"),
        F.lit(1).alias("quantity"),
        F.col("o_totalprice").alias("price"),
        F.col("o_totalprice").alias("total_amount"),
        F.when(status == "O", "placed").when(status == "P", "processing").otherwise("cancelled").alias("status"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )
    return order_rows.select(
        F.col("o_custkey").cast("string").alias("key"),
        F.to_json(record).alias("value"),
        F.lit(ORDERS_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        _offset(order_rows, F.col("o_orderkey")).alias("offset"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )


def flat_payment_messages(events: DataFrame) -> DataFrame:
    """Purchase and error events (batch or stream) as flat JSON payment messages."""
    paid = events.filter(F.col("event_type").isin("purchase", "error"))
    record = F.struct(
        F.col("event_id").cast("string").alias("payment_id"),
        F.col("event_id").cast("string").alias("order_id"),
        F.col("value").alias("amount"),
        _choice(F.col("user_id") % 6, [*METHODS, "EMI"]).alias("method"),
        F.when(F.col("event_type") == "purchase", "success").otherwise("failed").alias("status"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )
    return paid.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(record).alias("value"),
        F.lit(PAYMENTS_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        _offset(events, F.col("event_id")).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def flat_delivery_messages(lines: DataFrame) -> DataFrame:
    """Order lines with a city and a position (batch or stream) as flat JSON delivery messages."""
    flag = F.col("l_returnflag")
    line = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    record = F.struct(
        line.alias("delivery_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("city"),
        F.when(flag == "A", "dispatched").when(flag == "N", "in_transit").otherwise("out_for_delivery").alias("status"),
        (F.col("l_quantity").cast("int") % 10).alias("estimated_days"),
        F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )
    return lines.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(record).alias("value"),
        F.lit(DELIVERIES_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        _offset(lines, F.col("position")).alias("offset"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
    )
