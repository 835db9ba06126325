"""Tables whose changes appear at once.

A change writes the partitions it touches into a folder of its own and then commits which version
holds which partition (:class:`souk.sources.versions.Versions`). Readers of ``read_table`` see all of it or nothing;
a job that fails leaves the version before. ``mark`` names what a version reflects, so that a repeated
change is told apart from a new one. The last ``KEEP`` versions stay readable for queries that began on them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.grouping import last_per_key
from souk.sinks.writers import REUSE, _write
from souk.sources.schemas import Table
from souk.sources.tables import NULL_FOLDER, conform, read_folders
from souk.sources.versions import Versions

KEEP = 3


def current(spark: SparkSession, table: Table, root: str) -> tuple[int, dict]:
    """Number and content (``parts``, ``mark``) of the last version."""
    number, content = Versions(spark, table.path(root)).current()
    return number, content or {"parts": {}, "mark": None}


def commit_parts(
    rows: DataFrame, table: Table, root: str, replaced: Callable[[str], bool], mark: object = None
) -> None:
    """A version in which ``rows`` stand in place of all partitions whose name is ``replaced``."""
    versions = Versions(rows.sparkSession, table.path(root))
    number, content = current(rows.sparkSession, table, root)
    folder = f"version={number + 1}"
    _write(rows.select(*table.schema.names), table, root, mode="overwrite", below=f"/{folder}")
    written = [n for n in versions.names(folder) if n.startswith(f"{table.partition.name}=")]
    kept = {name: n for name, n in content["parts"].items() if not replaced(name)}
    versions.commit(number + 1, {"parts": {**kept, **dict.fromkeys(written, number + 1)}, "mark": mark})
    _expire(versions)


def _expire(versions: Versions) -> None:
    """Drop versions beyond the last ``KEEP`` and the partitions that only they use."""
    numbers = versions.numbers()
    gone = numbers[:-KEEP]
    if not gone:
        return
    used = {(n, name) for number in numbers[-KEEP:] for name, n in versions.read(number)["parts"].items()}
    old = {(n, name) for number in gone for name, n in versions.read(number)["parts"].items()}
    for n, name in old - used:
        versions.delete(f"version={n}/{name}")
    for number in gone:
        versions.delete(f"_versions/{number}.json")


def folder_name(table: Table, value: object) -> str:
    return f"{table.partition.name}={NULL_FOLDER if value is None else value}"


def replace_version(df: DataFrame, table: Table, root: str, since: Column | None = None, mark: object = None) -> None:
    """:func:`souk.sinks.writers.replace_range` as one version: all rows whose partition time is not before
    ``since`` (None: all rows) give way to ``df``."""
    spark = df.sparkSession
    rows = conform(last_per_key(df, table.keys), table)
    if since is None:
        return commit_parts(rows, table, root, lambda name: True, mark)
    column = F.col(table.partition.column)
    since = since.cast(table.schema[table.partition.column].dataType)
    first = folder_name(table, spark.range(1).select(table.partition.of(since).cast("string")).first()[0])
    border = {n: v for n, v in current(spark, table, root)[1]["parts"].items() if n == first}
    older = read_folders(spark, table, root, border).filter(column < since)
    rows = rows.filter(column >= since).unionByName(older)
    commit_parts(rows, table, root, lambda name: name >= first and not name.endswith(NULL_FOLDER), mark)


def merge_version(
    df: DataFrame, table: Table, root: str, combine: Callable[[DataFrame, DataFrame], DataFrame], mark: object = None
) -> None:
    """``combine(stored, new)`` in place of the partitions that ``df`` touches; a change whose ``mark`` the
    last version carries has been applied and does nothing."""
    spark = df.sparkSession
    _, content = current(spark, table, root)
    if mark is not None and content["mark"] == mark:
        return
    new = conform(df, table).persist(REUSE)
    try:
        touched = {folder_name(table, r[0]) for r in new.select(table.partition.name).distinct().collect()}
        stored = read_folders(spark, table, root, {n: v for n, v in content["parts"].items() if n in touched})
        commit_parts(conform(combine(stored, new), table), table, root, touched.__contains__, mark)
    finally:
        new.unpersist()


def changed_parts(spark: SparkSession, table: Table, root: str, since: int) -> tuple[dict, dict] | None:
    """The partitions that differ between version ``since`` and the last one, as stored in each; None if
    the former is no longer kept."""
    versions = Versions(spark, table.path(root))
    if since and since not in versions.numbers():
        return None
    before, now = (versions.read(since)["parts"] if since else {}), current(spark, table, root)[1]["parts"]
    names = {n for n in {*before, *now} if before.get(n) != now.get(n)}
    return {n: before[n] for n in names if n in before}, {n: now[n] for n in names if n in now}


def signed_changes(spark: SparkSession, table: Table, root: str, since: int) -> DataFrame | None:
    """Rows of the changed partitions with ``sign``: -1 as they were, 1 as they are."""
    parts = changed_parts(spark, table, root, since)
    if parts is None:
        return None
    old, new = (read_folders(spark, table, root, p).withColumn("sign", F.lit(s)) for p, s in zip(parts, (-1, 1)))
    return old.unionByName(new)


def named(parts: Iterable[str]) -> Callable[[str], bool]:
    return set(parts).__contains__
