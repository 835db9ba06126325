"""Reading and shaping tables that follow a contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from souk.sources.schemas import TABLES, Table
from souk.sources.versions import Versions

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # where Spark stores rows without a partition value


def conform(df: DataFrame, table: Table) -> DataFrame:
    """``df`` with exactly the table's columns: cast, defaults filled, partition column last."""
    columns = []
    for f in table.schema.fields:
        if table.partition and f.name == table.partition.name:
            continue
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in table.defaults:
            value = F.coalesce(value, F.expr(table.defaults[f.name]))
        columns.append(value.cast(f.dataType).alias(f.name))
    shaped = df.select(*columns)
    return shaped.select("*", table.partition.value()) if table.partition else shaped


def create_if_absent(spark: SparkSession, table: Table, root: str) -> None:
    """An empty table where there is none yet."""
    empty = spark.createDataFrame([], table.schema)
    writer = empty.write.mode("ignore")
    if table.partition:
        writer = writer.partitionBy(table.partition.name)
    writer.parquet(table.path(root))


def create_all(spark: SparkSession, root: str) -> None:
    for table in TABLES.values():
        create_if_absent(spark, table, root)


def read_table(
    spark: SparkSession,
    table: Table,
    root: str,
    since: Column | None = None,
    until: Column | None = None,
) -> DataFrame:
    """The table with its declared schema (no inference, partition column last).

    ``since`` / ``until`` leave out the time partitions before and after these moments; rows of
    the first and last partition are all kept, so the exact filter stays with the reader.
    """
    _, content = Versions(spark, table.path(root)).current()
    df = read_folders(spark, table, root, content["parts"]) if content else spark.read.schema(table.schema).parquet(table.path(root))
    if since is not None:
        df = df.filter(F.col(table.partition.name) >= table.partition.of(since))
    if until is not None:
        df = df.filter(F.col(table.partition.name) <= table.partition.of(until))
    return df


def read_folders(spark: SparkSession, table: Table, root: str, parts: dict[str, int]) -> DataFrame:
    """The rows of a versioned table: ``parts`` says which version holds each partition."""
    if not parts:
        return spark.createDataFrame([], table.schema)
    folder = table.path(root)
    reader = spark.read.schema(table.schema).option("basePath", folder)
    rows = reader.parquet(*(f"{folder}/version={number}/{name}" for name, number in sorted(parts.items())))
    return rows.select(*table.schema.names)


def read_partitions(
    spark: SparkSession, table: Table, root: str, values: Sequence[object]
) -> DataFrame:
    """The rows of the given partitions. Only their folders are listed, which matters to frequent
    small writes on a table with many files."""
    if not values:
        return spark.createDataFrame([], table.schema)
    folder, name = table.path(root), table.partition.name
    _, content = Versions(spark, folder).current()
    if content:
        names = {f"{name}={NULL_FOLDER if v is None else v}" for v in values}
        return read_folders(spark, table, root, {p: n for p, n in content["parts"].items() if p in names})
    wanted = [f"{name}={NULL_FOLDER if v is None else v}" for v in values]
    reader = spark.read.schema(table.schema).option("basePath", folder)
    try:
        return reader.parquet(f"{folder}/{{{','.join(wanted)}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], table.schema)  # none of them exists yet


def stored_partitions(spark: SparkSession, table: Table, root: str, since: Column | None = None) -> list:
    """The partition values that have a folder, from ``since`` on; no data file is read for it."""
    df = read_table(spark, table, root, since=since)
    return [r[0] for r in df.select(table.partition.name).distinct().collect()]


def drop_partitions(spark: SparkSession, table: Table, root: str, values: Sequence[object]) -> None:
    """Remove the folders of the given partitions."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for value in values:
        folder = f"{table.path(root)}/{table.partition.name}={NULL_FOLDER if value is None else value}"
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def jdbc_reader(
    spark: SparkSession,
    *,
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str = "org.postgresql.Driver",
    split_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrameReader:
    """A configured JDBC reader; call ``.load()``. With ``split_column`` the table is read in
    parallel ranges, without it by one task."""
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("user", user)
        .option("password", password)
        .option("driver", driver)
        .option("fetchsize", fetch_size)
    )
    if split_column:
        if not (bounds and partitions):
            raise ValueError("a split read needs bounds and a partition count")
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader
