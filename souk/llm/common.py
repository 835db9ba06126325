"""Helpers of the corpus operators: stored steps, sliced batches, words and hashes of bytes.

Tasks see texts as Arrow buffers: one array of bytes and the offsets of the texts in it. Work on
them is vectorised, a few megabytes of text at a time, so a task's memory does not depend on the
number of rows. Null texts count as empty ones.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from souk.session import run_dir

SLICE_BYTES = 1 << 20
U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

_shipped: dict[str, str] = {}
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def stored(df: DataFrame, name: str, seen: Observation | None = None, *measures: Column) -> DataFrame:
    """``df`` written to the shared folder and read again: lost executors cost no recomputation.

    ``measures`` are taken of the rows on their way, into ``seen``.
    """
    path = run_dir(df.sparkSession, f"llm-{name}")
    (df.observe(seen, *measures) if seen else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shards(spark: SparkSession) -> int:
    """Number of shuffle partitions, which the cluster sizes to its input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application."""
    context = spark.sparkContext
    if _shipped.get("to") != context.applicationId:
        root = Path(__file__).resolve().parents[2]
        if not root.is_dir():
            return  # this already runs from a shipped archive
        with tempfile.TemporaryDirectory() as folder:
            copy = Path(folder, "code")
            shutil.copytree(root / "souk", copy / "souk", ignore=shutil.ignore_patterns("__pycache__"))
            context.addPyFile(shutil.make_archive(str(Path(tempfile.mkdtemp(), "souk-code")), "zip", copy))
        _shipped["to"] = context.applicationId


def corpus(docs: DataFrame, *extra: str) -> DataFrame:
    """Only the columns an operator reads, whatever else the table has."""
    return docs.select("doc_id", "text", *extra)


def fold(column: str, modulus: int) -> F.Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string")) % F.lit(modulus)


def byte_column(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its values."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends


def slices(
    batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of at most ``limit`` bytes of text (one longer text stays whole): rows, bytes, offsets."""
    for batch in batches:
        data, ends = byte_column(batch, name)
        start, n = 0, batch.num_rows
        while start < n:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1)
            stop = min(stop, n)
            yield batch.slice(start, stop - start), data[ends[start] : ends[stop]], ends[start : stop + 1] - ends[start]
            start = stop


def strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return data + np.uint8(32) * ((data >= 65) & (data <= 90))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word ``[^\\x20\\x09-\\x0D]+``."""
    white = WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[-1] = True
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = white[:-1], white[1:]
    starts = np.flatnonzero(~white & (before | edge[:-1]))
    ends = np.flatnonzero(~white & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` for i < n."""
    if len(_powers["up"]) < n:
        for key, base in (("up", BASE), ("down", BASE_INVERSE)):
            table = np.full(n, base, U64)
            table[0] = 1
            _powers[key] = np.cumprod(table, dtype=U64)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial in ``BASE``; :func:`span_hashes` reads any span's hash off them."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(len(data) + 1)[0][:-1], dtype=U64, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, equal for equal bytes wherever they stand."""
    return mixed((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """``n`` keys, one for each of ``n`` hash partitions, so that shards are dealt evenly."""
    found = spark.range(30 * n + 100).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("part")).agg(F.min("id").alias("key"))
    keys = sorted(r["key"] for r in found.collect())
    return keys if len(keys) == n else list(range(n))


BINS = 4096


def kth_largest(df: DataFrame, column: str, k: int) -> tuple[float, int]:
    """The k-th largest value, and how many rows are above it, by refining histograms."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    above = 0
    while low is not None and low < high:
        width = (high - low) / BINS
        inside = df.where(F.col(column).between(low, high))
        slot = F.least(F.floor((F.col(column) - low) / width), F.lit(BINS - 1)) if width else F.lit(0)
        bins = inside.groupBy(slot.alias("slot")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
        for row in sorted(bins.collect(), key=lambda r: -r["slot"]):  # BINS rows at most
            if above + row["n"] >= k:
                low, high = row["lo"], row["hi"]
                break
            above += row["n"]
        else:
            break
    return low, above
