"""The ids a table holds, in hash buckets beside the table.

Streams whose ids may come back at any time look them up here instead of keeping them as state. Each
batch adds one small run of its new ids; when there are ``FAN`` runs of a level they are merged into one of the
next, which is stored by hash bucket, so an id is rewritten a few times however long the stream runs. A lookup reads
the small runs and, of the merged ones, the buckets that the batch's ids fall into.

The runs of the index are listed in a version (:class:`souk.sources.versions.Versions`): a batch's run counts from its
commit on, and a merge replaces its runs in one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.sources.schemas import KEY_BUCKETS, Table
from souk.sources.tables import read_table
from souk.sources.versions import Versions

FAN = 8
BUCKET = "key_bucket"


class KeyIndex:
    def __init__(self, spark: SparkSession, table: Table, root: str, buckets: int = KEY_BUCKETS):
        self.spark, self.table, self.root, self.buckets = spark, table, root, buckets
        self.folder = f"{root}/_ids/{table.name.replace('.', '/')}"
        self.versions = Versions(spark, self.folder)
        self.number, content = self.versions.current()
        self.runs: list[list] = content.get("runs", [])  # [name, level]
        if not self.number:
            self._start()

    def _start(self) -> None:
        """Take over what the table holds already."""
        held = Versions(self.spark, self.table.path(self.root)).names()
        if any("=" in name or name.endswith(".parquet") for name in held):
            self.add(read_table(self.spark, self.table, self.root))

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        keys = self.table.keys
        return rows.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int").alias(BUCKET))

    def _schema(self):
        return self._bucketed(self.spark.createDataFrame([], self.table.schema)).schema

    def _read(self, runs: list[list], buckets: list[int] | None) -> DataFrame | None:
        """The ids of runs; ``buckets`` limits the merged ones."""
        small = [f"{self.folder}/{name}" for name, level in runs if level == 0]
        merged = [name for name, level in runs if level > 0]
        parts = [self.spark.read.schema(self._schema()).parquet(*small)] if small else []
        for name in merged:
            held = set(self.versions.names(name))
            wanted = [x for x in held if x.startswith(BUCKET) and (buckets is None or int(x.split("=")[1]) in buckets)]
            if wanted:
                reader = self.spark.read.schema(self._schema()).option("basePath", f"{self.folder}/{name}")
                parts.append(reader.parquet(*(f"{self.folder}/{name}/{x}" for x in sorted(wanted))))
        if not parts:
            return None
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def held(self, rows: DataFrame) -> DataFrame | None:
        """The ids of the runs and buckets that ``rows`` have to be compared with; None if there are none."""
        buckets = None
        if any(level for _, level in self.runs):
            buckets = [r[0] for r in self._bucketed(rows).select(BUCKET).distinct().collect()]  # at most all buckets
        found = self._read(self.runs, buckets)
        return None if found is None else found.select(*self.table.keys)

    def add(self, rows: DataFrame) -> None:
        """Add ids as a run of their own, then merge runs where a level is full."""
        name = f"run-{self.number + 1}"
        self._bucketed(rows).hint("rebalance").write.mode("overwrite").parquet(f"{self.folder}/{name}")
        self._commit([*self.runs, [name, 0]])
        level = 0
        while len(full := [r for r in self.runs if r[1] == level]) >= FAN:
            self._merge(full, level + 1)
            level += 1

    def _merge(self, runs: list[list], level: int) -> None:
        name = f"run-{self.number + 1}"
        together = self._read(runs, None).hint("rebalance", BUCKET)
        together.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.folder}/{name}")
        self._commit([*(r for r in self.runs if r not in runs), [name, level]])
        for old, _ in runs:
            self.versions.delete(old)

    def _commit(self, runs: list[list]) -> None:
        self.versions.commit(self.number + 1, {"runs": runs})
        self.number, self.runs = self.number + 1, runs
        if self.number > 2:
            self.versions.delete(f"_versions/{self.number - 2}.json")
