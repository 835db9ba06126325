"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine ``c`` are ``sqrt(2 - 2c)`` apart, and no further apart in any projection. The
vectors are projected on their leading principal dimensions, sorted by the grid cells there
(the epsilon grid order) and cut into blocks of the sorted sequence. Blocks meet if their
bounding boxes in the projection are near; a pair of blocks is joined recursively, by
halves, skipping halves that are provably distant, until small intervals are compared in full.

Equal vectors of a label are one representative with a weight. A pair of blocks reports link
counts per vector and links that span its components, never all its links.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those
without a label, link with nothing; vectors of different length never link; rows with
equal ids are separate vectors of one id; vectors without an id link like others and do not name a component: one
of only such vectors has none, and they are its kept ones; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.common import shards, stored
from souk.llm.components import components

COSINE = 0.98
LEADING = 6
BLOCK = 256
LEAF = 64
MARGIN = 1e-9


def rows_of(column: pa.Array) -> np.ndarray:
    """A list column of vectors of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def unit(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # no overflow or underflow of squares
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def can_link() -> Column:
    """Whether a vector has a label and only finite components, not all of them zero."""
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))  # noqa: E731  NaN is above all
    good = F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    return F.col("label").isNotNull() & F.coalesce(good, F.lit(False))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dims, vector) of the vectors that can link."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    return vectors.where(can_link()).select("vec_id", "label", F.size("embedding").alias("dims"), vector.alias("vector"))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of products of the components, per vector length."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = batch.column(0).to_numpy()
        for d in np.unique(dims):
            x = unit(rows_of(batch.column(1).filter(pa.array(dims == d))))
            sums[int(d)] = sums.get(int(d), 0) + x.T @ x
    for d, products in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(d * d, d)), pa.array(np.arange(d * d)), pa.array(products.ravel())], ["dims", "cell", "value"]
        )


def principal_axes(reps: DataFrame, leading: int = LEADING) -> dict[int, np.ndarray]:
    """The leading principal dimensions for each vector length."""
    sums = reps.select("dims", "vector").mapInArrow(_moments, "dims long, cell long, value double")
    axes: dict[int, np.ndarray] = {}
    cells = sums.groupBy("dims", "cell").agg(F.sum("value").alias("value")).toPandas()  # a square of the length
    for d, part in cells.groupby("dims"):
        products = np.zeros(int(d) ** 2)
        products[part["cell"]] = part["value"]
        axes[int(d)] = np.linalg.eigh(products.reshape(int(d), int(d)))[1][:, ::-1][:, :leading]
    return axes


BLOCKS = "block long, label string, dims long, reps binary, weights binary, units binary, low array<double>, high array<double>"


def grid_blocks(reps: DataFrame, axes: dict[int, np.ndarray], eps: float, block: int = BLOCK) -> DataFrame:
    """The sequence in epsilon grid order, cut into blocks with their bounding boxes."""
    leading = max((a.shape[1] for a in axes.values()), default=1)
    grid = ", ".join(f"g{k} long" for k in range(leading))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy()
            cells = np.zeros((batch.num_rows, leading), np.int64)
            for d in np.unique(dims):
                of = dims == d
                spot = unit(rows_of(batch.column(4).filter(pa.array(of)))) @ axes[int(d)]
                cells[of, : spot.shape[1]] = np.floor(spot / eps)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c) for c in cells.T)], [*batch.schema.names, *(f"g{k}" for k in range(leading))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            label, dims = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy()
            new = np.zeros(len(label), bool)
            new[1:] = (label[1:] != label[:-1]) | (dims[1:] != dims[:-1])
            edges = np.append(np.append([0], np.flatnonzero(new)), len(label)) if len(label) else np.zeros(1, int)
            out = []
            for a, b in zip(edges, edges[1:]):
                for start in range(a, b, block):
                    stop = min(start + block, b)
                    units = unit(rows_of(batch.column(4).slice(start, stop - start)))
                    spot = units @ axes[int(dims[start])]
                    reps_, weights = (batch.column(k).to_numpy()[start:stop].astype(np.int64).tobytes() for k in (0, 1))
                    out.append((part << 32 | count, label[start], dims[start], reps_, weights, units.tobytes(), spot.min(axis=0), spot.max(axis=0)))
                    count += 1
            kinds = [pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * 3 + [pa.list_(pa.float64())] * 2
            names = [x.split()[0] for x in BLOCKS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*out) if out else [[]] * 8, kinds)], names)

    order = ["label", "dims", *(f"g{k}" for k in range(leading)), "rep"]
    columns = reps.select("rep", "weight", F.col("label").cast("string"), F.col("dims").cast("long"), "vector")
    placed = columns.mapInArrow(project, f"rep long, weight long, label string, dims long, vector array<double>, {grid}")
    sequence = placed.repartitionByRange(shards(reps.sparkSession), *order).sortWithinPartitions(*order)
    return sequence.mapInArrow(cut, BLOCKS)


def near_blocks(boxes: DataFrame, eps: float) -> DataFrame:
    """Pairs of blocks of a label whose boxes are within ``eps`` in every leading dimension.

    Blocks meet over stripes of the first dimension, so only neighbours in it are compared.
    """
    stripe = lambda x: F.floor(x / eps)
    left = boxes.select("label", "dims", *(F.col(c).alias(f"left_{c}") for c in ("block", "low", "high"))).withColumn(
        "stripe", F.explode(F.sequence(stripe(F.get("left_low", 0)), stripe(F.get("left_high", 0))))
    )
    right = boxes.select("label", "dims", *(F.col(c).alias(f"right_{c}") for c in ("block", "low", "high"))).withColumn(
        "stripe", F.explode(F.sequence(stripe(F.get("right_low", 0)) - 1, stripe(F.get("right_high", 0)) + 1))
    )
    apart = lambda low, high: F.exists(F.arrays_zip(low, high), lambda x: x[low] - x[high] > eps + MARGIN)
    met = left.join(right, ["label", "dims", "stripe"]).where("left_block <= right_block")
    near = met.where(~apart("left_low", "right_high") & ~apart("right_low", "left_high"))
    return near.select("left_block", "right_block").distinct()


def linked_cells(left: np.ndarray, right: np.ndarray, axes: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of two intervals link, by recursive halving."""
    eps = np.sqrt(2 - 2 * cosine) + MARGIN
    spots = left @ axes, right @ axes
    out = np.zeros((len(left), len(right)), bool)
    waiting = [(0, len(left), 0, len(right))]
    while waiting:
        a, b, c, d = waiting.pop()
        one, two = spots[0][a:b], spots[1][c:d]
        if (one.min(axis=0) - two.max(axis=0) > eps).any() or (two.min(axis=0) - one.max(axis=0) > eps).any():
            continue
        if max(b - a, d - c) <= LEAF:
            out[a:b, c:d] = left[a:b] @ right[c:d].T >= cosine
        elif b - a >= d - c:
            waiting += [(a, (a + b) // 2, c, d), ((a + b) // 2, b, c, d)]
        else:
            waiting += [(a, b, c, (c + d) // 2), (a, b, (c + d) // 2, d)]
    return out


def spanning(links: np.ndarray) -> np.ndarray:
    """For each row and then each column of a link matrix, the smallest place of its component."""
    n, m = links.shape
    place = np.arange(n + m)
    while True:
        rows = np.minimum(place[:n], np.where(links, place[None, n:], n + m).min(axis=1, initial=n + m))
        columns = np.minimum(place[n:], np.where(links, rows[:, None], n + m).min(axis=0, initial=n + m))
        new = np.concatenate([rows, columns])
        new = new[new]
        if (new == place).all():
            return place
        place = new


def join_blocks(pairs: DataFrame, blocks: DataFrame, axes: dict[int, np.ndarray], cosine: float) -> DataFrame:
    """(rep, links, peer): partial link counts, and a link that keeps the component together."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                d = row["dims"]
                reps = [np.frombuffer(row[f"{side}_reps"], np.int64) for side in ("left", "right")]
                weights = [np.frombuffer(row[f"{side}_weights"], np.int64) for side in ("left", "right")]
                units = [np.frombuffer(row[f"{side}_units"], float).reshape(-1, d) for side in ("left", "right")]
                links = linked_cells(*units, axes[d], cosine)
                same = row["left_block"] == row["right_block"]
                if same:
                    np.fill_diagonal(links, False)
                counts = links @ weights[1]
                counts = np.concatenate([counts, np.zeros(len(reps[1]), np.int64) if same else weights[0] @ links])
                ids = np.concatenate(reps)
                peers = ids[spanning(links)]
                some = counts > 0
                if same:
                    some = np.concatenate([some[: len(reps[0])]] * 2)
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(counts[some]), pa.array(peers[some])], ["rep", "links", "peer"])

    side = lambda name: blocks.select(
        F.col("block").alias(f"{name}_block"), *(F.col(c).alias(f"{name}_{c}") for c in ("reps", "weights", "units")),
        *(["dims"] if name == "left" else []),
    )
    full = pairs.join(side("left"), "left_block").join(side("right"), "right_block")
    return full.mapInArrow(joined, "rep long, links long, peer long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: its links, the smallest id of its component, and whether it is that one."""
    eps = float(np.sqrt(2 - 2 * cosine))
    used = usable(vectors.select("vec_id", "embedding", "label"))
    # the printed components of equal vectors are equal
    keyed = used.withColumn("digest", F.sha2(F.concat_ws(" ", "label", F.col("vector").cast("string")), 256))
    classes_of = keyed.groupBy("digest").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first("label").alias("label"),
        F.first("dims").alias("dims"), F.first("vector").alias("vector"),
    )
    # numbers of their own, fixed once they are stored: ids may repeat or be missing
    reps = stored(classes_of.withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    axes = principal_axes(reps)
    blocks = stored(grid_blocks(reps, axes, eps), "blocks")
    pairs = stored(near_blocks(blocks.select("block", "label", "dims", "low", "high"), eps), "block-pairs")
    pairs = pairs.repartition(shards(vectors.sparkSession), "left_block", "right_block")
    found = stored(join_blocks(pairs, blocks, axes, cosine), "vector-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(found.where("rep <> peer"), "rep", "peer").select(F.col("vertex").alias("rep"), "component")
    merged = reps.select("digest", "rep", "least", "weight").join(counts, "rep", "left").join(classes, "rep", "left")
    merged = stored(
        merged.select(
            "digest", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component"), "least",
        ),
        "vector-verdicts",
    )
    names = merged.groupBy("component").agg(F.min("least").alias("component_id"))
    merged = merged.join(names, "component")
    linked = keyed.select("vec_id", "digest").join(merged, "digest").select("vec_id", "n_links", "component_id")
    alone = vectors.where(~can_link()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
