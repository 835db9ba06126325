"""Bloom filters of the keys in each partition of a table.

A batch that inserts rows whose key is not there yet must search the whole table, as the key does not tell
the partition. The filters name the partitions that may hold one of its keys; only their key columns are read. They
are Spark's own bitmaps: a segment of 32,768 bits per ``KEYS`` keys of the write's largest partition, and ``PLACES`` bits per key,
all in one segment. A partition that one key names needs no other keys, so a large batch asks with ``PROBES`` of its keys
first and with the others only for the partitions not named by then. Each
write adds the filters of its new rows before the rows themselves, so a failed write leaves at worst a
filter that says maybe. After ``FAN`` writes the partitions they went to get filters of their own size (:meth:`rebuild`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.sources.schemas import Table
from souk.sources.tables import NULL_FOLDER, read_partitions
from souk.sources.versions import Versions

BITMAP = 32768  # fixed: bits of a bitmap of bitmap_construct_agg
KEYS = 2048  # keys per segment: 16 bits each
PLACES = 4
PROBES = 8192
FAN = 16
SCHEMA = "part STRING, segments LONG, segment LONG, bits BINARY"


class KeyFilters:
    def __init__(self, spark: SparkSession, table: Table, root: str):
        self.spark, self.table, self.root = spark, table, root
        self.folder = f"{root}/_filters/{table.name.replace('.', '/')}"
        self.versions = Versions(spark, self.folder)
        self.number, content = self.versions.current()
        self.runs: list[dict] = content.get("runs", [])  # name, parts, segments, level

    def _part(self):
        """The partition a row belongs to, as it is named in the table's folder."""
        return F.coalesce(F.col(self.table.partition.name).cast("string"), F.lit(NULL_FOLDER)).alias("part")

    def _bits(self) -> list[str]:
        """The places of a key in its segment: 15 bits of a second hash each."""
        second = f"xxhash64({', '.join(self.table.keys)}, 1)"
        return [f"cast(shiftright({second}, {15 * i}) & {BITMAP - 1} as int)" for i in range(PLACES)]

    def uncovered(self) -> list[str]:
        """Partitions with data that no filter speaks of (rows written without them)."""
        prefix = f"{self.table.partition.name}="
        folders = Versions(self.spark, self.table.path(self.root)).names()
        covered = {p for run in self.runs for p in run["parts"]}
        return sorted({f.removeprefix(prefix) for f in folders if f.startswith(prefix)} - covered)

    def partitions_of(self, rows: DataFrame) -> list[str]:
        """The partitions that may hold a key of ``rows``."""
        found = set(self.uncovered())
        covered = {p for run in self.runs for p in run["parts"]}
        if covered - found:
            slices = max(1, rows.count() // PROBES)
            turn = F.pmod(F.xxhash64(*self.table.keys, F.lit(2)), F.lit(slices)) == 0
            found |= self._named(rows.where(turn), covered - found)
            if slices > 1 and covered - found:
                found |= self._named(rows.where(~turn), covered - found)
        return sorted(found)

    def _named(self, rows: DataFrame, parts: set[str]) -> set[str]:
        """Those of ``parts`` whose filters may hold a key of ``rows``."""
        runs = [run for run in self.runs if not parts.isdisjoint(run["parts"])]
        sizes = sorted({run["segments"] for run in runs})
        probes = rows.select(
            F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])).alias("segments"),
            F.xxhash64(*self.table.keys).alias("first"),
            F.array(*map(F.expr, self._bits())).alias("places"),
        ).select("segments", F.pmod("first", F.col("segments")).alias("segment"), "places")
        filters = self._read(runs).where(F.col("part").isin(*sorted(parts)))
        met = filters.join(probes, ["segments", "segment"]).where(
            F.expr(
                "forall(places, p -> (cast(conv(hex(substring(bits, shiftright(p, 3) + 1, 1)), 16, 10) as int)"
                " & shiftleft(1, p & 7)) != 0)"
            )
        )
        return {r[0] for r in met.select("part").distinct().collect()}  # at most the table's partitions

    def known(self, rows: DataFrame) -> DataFrame:
        """The stored rows to compare ``rows`` with."""
        parts = [None if p == NULL_FOLDER else p for p in self.partitions_of(rows)]
        return read_partitions(self.spark, self.table, self.root, parts)

    def _read(self, runs: Sequence[dict]) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(*(f"{self.folder}/{run['name']}" for run in runs))

    def _write(self, rows: DataFrame, segments: int) -> dict:
        run = {"name": f"run-{self.number + 1}", "segments": segments}
        hashed = rows.select(
            self._part(), F.pmod(F.xxhash64(*self.table.keys), F.lit(segments)).alias("segment"),
            F.array(*map(F.expr, self._bits())).alias("places"),
        )
        # the keys are shuffled, not bitmaps: each map task would have nearly empty ones of all segments
        places = hashed.repartition("part", "segment").select("part", "segment", F.explode("places").alias("place"))
        maps = places.groupBy("part", "segment").agg(F.bitmap_construct_agg("place").alias("bits"))
        path = f"{self.folder}/{run['name']}"
        maps.select("part", F.lit(segments).cast("long").alias("segments"), "segment", "bits").write.mode("overwrite").parquet(path)
        written = self.spark.read.schema(SCHEMA).parquet(path)
        return {**run, "parts": sorted(r[0] for r in written.select("part").distinct().collect())}

    def _most(self, rows: DataFrame) -> int:
        """Keys of the largest partition."""
        return rows.groupBy(self._part()).count().agg(F.max("count")).first()[0] or 0

    def add(self, rows: DataFrame) -> None:
        """Filters of new rows (with their partition column); call it before the rows are written."""
        run = {**self._write(rows, segments_for(self._most(rows))), "level": 0}
        if run["parts"]:
            self._commit([*self.runs, run])
        if sum(r["level"] == 0 for r in self.runs) > FAN:
            self.rebuild()

    def rebuild(self) -> None:
        """One run, of the right size, for all partitions that small runs cover, from the stored rows.

        The last run stays, as its rows may still have to be written. Older filters of these partitions go.
        """
        last = self.runs[-1]
        small = [r for r in self.runs[:-1] if r["level"] == 0]
        parts = sorted({p for r in small for p in r["parts"]} | set(self.uncovered()))
        rows = read_partitions(self.spark, self.table, self.root, [None if p == NULL_FOLDER else p for p in parts])
        run = {**self._write(rows, segments_for(self._most(rows))), "parts": parts, "level": 1}
        older = [{**r, "parts": sorted(set(r["parts"]) - set(parts))} for r in self.runs if r["level"]]
        self._commit([*(r for r in older if r["parts"]), run, last])
        for old in (*small, *(r for r in older if not r["parts"])):
            self.versions.delete(old["name"])

    def _commit(self, runs: list[dict]) -> None:
        self.versions.commit(self.number + 1, {"runs": runs})
        self.number, self.runs = self.number + 1, runs
        if self.number > 2:
            self.versions.delete(f"_versions/{self.number - 2}.json")


def segments_for(keys: int) -> int:
    """Segments for so many keys; a power of two, so that few sizes occur."""
    return 1 << max(0, (max(1, keys) - 1) // KEYS).bit_length()
