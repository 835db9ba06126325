"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A document is its five-word shingles, weighted by how often they occur. Each shingle sends a Poisson
process of arrivals, as fast as its weight, to random registers; a register keeps the shingle that
arrives first, so two documents agree in a register with their probability Jaccard similarity. A
shingle stops once its next arrival is later than all registers' (early termination).

Equal texts are one representative with a number of its own. Representatives that agree in a band share a
bucket, and buckets that share a member form a cluster; only its members can be linked. Links are
decided by exact similarity, and only those that span a class are kept:

* A large cluster first compares all its members with one hub, a few times. What the triangle
  inequality of the distance rules out after that is done.
* What is left, and all smaller clusters, are compared in blocks of bounded size, pairs of blocks in
  tasks of their own. A pair that already is of one class, or shares no band, is skipped.

So no link between classes is lost, and the pairs of a cluster are never listed.

Defined results: a text of one to four words is one shingle; null and word-free texts are never
linked, not even with each other; equal rows are copies; ids may be missing or repeat, as every row is
judged by its own text: a class is named by the smallest id in it, and its rows with another id or
none are not kept; a class without any id has no name, and all its rows are kept; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.common import (
    U64, byte_column, corpus, mixed, numbers, prefix_sums, slices, span_hashes, stored, word_spans,
)
from souk.llm.components import components

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
BLOCK = 128
HUB_ROUNDS = 2
SIGNATURES = "doc_id long, digest binary, bands array<long>"


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text number, shingle hash) in order, with counts."""
    starts, ends, doc = word_spans(data, offsets)
    hashes = span_hashes(prefix_sums(data), starts, ends)
    per_doc = np.bincount(doc, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(per_doc)])
    size = np.minimum(per_doc, words)  # words of a shingle in this text
    total = np.zeros(len(hashes), U64)
    padded = np.concatenate([hashes, np.zeros(words, U64)])
    here = size[doc]
    for k in range(words):
        use = np.where(k < here, padded[k : k + len(hashes)], U64(0))
        total = total * U64(0x9E3779B97F4A7C15) + use
    whole = np.arange(len(hashes)) + here <= first[doc + 1]
    key, doc = mixed(total[whole]), doc[whole]
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], key[at], np.diff(np.append(at, len(key)))


def signatures(doc: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """The element that arrived first in each register, for ``n`` documents."""
    arrival = np.full(n * registers, np.inf)
    element = np.zeros(n * registers, U64)
    latest = np.full(n, np.inf)
    sizes = np.bincount(doc, minlength=n)
    alone = sizes[doc] == 1  # a single element wins every register
    element.reshape(n, registers)[doc[alone]] = key[alone][:, None]
    live = np.flatnonzero(~alone)
    time = np.zeros(len(live))
    step = 0
    while len(live):
        random = mixed(key[live] + U64((2 * step + 1) * 0xD1342543DE82EF95 % (1 << 64)))
        time = time - np.log((random >> U64(11)).astype(float) * 2.0**-53 + 2.0**-54) / weight[live]
        early = time <= latest[doc[live]]
        live, time, random = live[early], time[early], random[early]
        slot = doc[live] * registers + (mixed(random) % U64(registers)).astype(np.int64)
        np.minimum.at(arrival, slot, time)
        won = arrival[slot] == time
        element[slot[won]] = key[live[won]]
        latest = arrival.reshape(n, registers).max(axis=1)
        step += 1
    return element.reshape(n, registers)


def band_keys(found: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    total = np.zeros((len(found), bands), U64)
    for k in range(rows):
        total = total * U64(0x9E3779B97F4A7C15) + found.reshape(len(found), bands, rows)[:, :, k]
    return mixed(total + np.arange(1, bands + 1, dtype=U64) * U64(0xD1342543DE82EF95)).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in slices(batches):
        n = batch.num_rows
        digests = [hashlib.md5(data[offsets[i] : offsets[i + 1]]).digest() for i in range(n)]
        at: dict[bytes, int] = {}
        own = np.array([at.setdefault(digest, i) == i for i, digest in enumerate(digests)])
        doc, key, count = shingles(data, offsets)
        mine = own[doc]  # copies within the slice are signed once
        keys = band_keys(signatures(doc[mine], key[mine], count[mine].astype(float), n))
        wordless = np.bincount(doc, minlength=n) == 0
        bands = [None if wordless[at[digest]] else keys[at[digest]] for digest in digests]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "digest", "bands"],
        )


def probability_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two weighted sets, each given as (sorted elements, weights)."""
    if not len(x[0]) or not len(y[0]):
        return 0.0
    elements = np.union1d(x[0], y[0])
    a, b = np.zeros(len(elements)), np.zeros(len(elements))
    a[np.searchsorted(elements, x[0])], b[np.searchsorted(elements, y[0])] = x[1], y[1]
    ratio = np.full(len(elements), np.inf)
    np.divide(a, b, out=ratio, where=b > 0)
    order = np.argsort(ratio, kind="stable")
    ratio, a, b = ratio[order], a[order], b[order]
    first = np.searchsorted(ratio, ratio, side="left")  # all with the same ratio count as one
    a_above = np.cumsum(a[::-1])[::-1][first]
    b_below = np.concatenate([[0.0], np.cumsum(b)])[first]
    both = (a > 0) & (b > 0)
    return float((1.0 / (a_above[both] / a[both] + b_below[both] / b[both])).sum())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo: tuple[bytes, tuple] = (b"\0", ((), ()))  # a hub's shingles serve all its pairs in a row
    for batch in batches:
        left, left_ends = byte_column(batch, "hub_text")
        right, right_ends = byte_column(batch, "rep_text")
        found = []
        for i in range(batch.num_rows):
            hub = left[left_ends[i] : left_ends[i + 1]].tobytes()
            if memo[0] != hub:
                memo = (hub, shingles(np.frombuffer(hub, np.uint8), np.array([0, len(hub)]))[1:])
            text = right[right_ends[i] : right_ends[i + 1]]
            found.append(1.0 - probability_jaccard(memo[1], shingles(text, np.array([0, len(text)]))[1:]))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in range(4)), pa.array(found, pa.float64())], ["cluster", "hub", "rep", "class", "d"]
        )


def distances(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(cluster, hub, rep, class) with the exact distance of hub and rep."""
    named = lambda side: texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"{side}_text"))
    with_texts = pairs.join(named("rep"), "rep").join(named("hub"), "hub")
    with_texts = with_texts.select("cluster", "hub", "rep", "class", "hub_text", "rep_text")
    return with_texts.mapInArrow(_verify, "cluster long, hub long, rep long, class long, d double")


def hub_rounds(members: DataFrame, texts: DataFrame, similarity: float, rounds: int = HUB_ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Links of large clusters to their hubs, and the (cluster, rep, class) that stay open.

    In a round all members of a cluster are compared with one hub, a member no hub was near to yet. The
    class of a member is the first hub it links to. With d the distance to the hub, two members are at
    least the difference of their d apart: a member stays only while a member of another class
    can still be near it.
    """
    far = 1.0 - similarity
    links: DataFrame | None = None
    state = members.select("cluster", "rep", F.col("rep").alias("class"))
    for _ in range(rounds):
        alone = F.when(F.col("class") == F.col("rep"), F.col("rep"))
        hubs = state.groupBy("cluster").agg(F.min(alone).alias("hub"), F.count("*").alias("n"))
        hubs = stored(hubs.where("n > 1 and hub is not null").select("cluster", "hub"), "hubs")
        pairs = state.join(hubs, "cluster").where("rep <> hub").select("cluster", "hub", "rep", "class")
        measured = stored(distances(pairs, texts), "distances")
        linked = F.col("d") <= far + 1e-12
        fresh = measured.where(linked).select("hub", "rep")
        links = fresh if links is None else links.union(fresh)
        named = F.when(linked & (F.col("class") == F.col("rep")), F.col("hub")).otherwise(F.col("class"))
        judged = measured.select("cluster", "rep", "d", named.alias("class"))
        nearest = judged.groupBy("cluster", "class").agg(F.min("d").alias("d"))
        first = nearest.groupBy("cluster").agg(F.min(F.struct("d", "class")).alias("first"))
        other = nearest.join(first, "cluster").where(F.col("class") != F.col("first.class"))
        other = stored(other.groupBy("cluster").agg(F.first("first").alias("first"), F.min("d").alias("second")), "nearest")
        reach = F.when(F.col("class") == F.col("first.class"), F.col("second")).otherwise(F.col("first.d"))
        untouched = state.join(hubs, "cluster", "left_anti")  # no member without a class is left there
        kept = judged.join(other, "cluster").where(F.col("d") >= reach - far - 1e-9).select("cluster", "rep", "class")
        state = stored(kept.union(untouched.select("cluster", "rep", "class")), "state")
    return links, state


def upper_bounds(i: int, element: np.ndarray, weight: np.ndarray, starts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """At least the similarity of set ``i`` with each of the sets that lie one after the other.

    For an element of both, the sum in the similarity is no less than what either set has in all
    plus what only the other one has. Without repeated shingles this is the similarity itself.
    """
    ends = np.append(starts[1:], len(element))
    mine = np.zeros(int(element.max()) + 1)
    mine[element[starts[i] : ends[i]]] = weight[starts[i] : ends[i]]
    x, sizes = mine[element], ends - starts
    both = x > 0
    x_only = total[i] - np.add.reduceat(x, starts)
    y_only = total - np.add.reduceat(np.where(both, weight, 0.0), starts)
    of = np.repeat(np.arange(len(starts)), sizes)[both]
    x, y = x[both], weight[both]
    term = np.zeros(len(element))
    term[both] = 1.0 / np.maximum(total[i] / x + y_only[of] / y, total[of] / y + x_only[of] / x)
    return np.add.reduceat(term, starts)


LINKS = "hub long, rep long"


def _compare_block(similarity: float):
    """Links that span the classes among the members of two blocks of a cluster."""

    def compare(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        block, reps, classes = (numbers(batch, c) for c in ("block", "rep", "class"))
        crossed = numbers(batch, "left")[0] != numbers(batch, "right")[0]
        bands = np.array(batch.column(batch.schema.get_field_index("bands")).to_pylist(), np.int64)
        data, ends = byte_column(batch)
        doc, key, count = shingles(data[ends[0] : ends[-1]], ends - ends[0])
        starts = np.searchsorted(doc, np.arange(len(reps)))  # members have bands, so none is empty
        element = np.unique(key, return_inverse=True)[1]
        weight = count.astype(float)
        total = np.add.reduceat(weight, starts)
        edges = np.append(starts, len(key))
        of_class = {c: i for i, c in reversed(list(enumerate(classes.tolist())))}
        root = np.array([of_class[c] for c in classes.tolist()])
        found = []
        for i in range(len(reps) - 1):
            near = (bands[i + 1 :] == bands[i]).any(axis=1) & (root[i + 1 :] != root[i])
            if crossed:
                near &= block[i + 1 :] != block[i]
            if not near.any():
                continue
            near &= upper_bounds(i, element, weight, starts, total)[i + 1 :] >= similarity - 1e-9
            for j in (np.flatnonzero(near) + i + 1).tolist():
                if root[i] != root[j]:
                    sets = [(key[edges[k] : edges[k + 1]], count[edges[k] : edges[k + 1]]) for k in (i, j)]
                    if probability_jaccard(*sets) >= similarity - 1e-12:
                        root[root == root[j]] = root[i]
                        found.append((int(reps[i]), int(reps[j])))
        return pa.table({"hub": pa.array([x[0] for x in found], pa.int64()), "rep": pa.array([x[1] for x in found], pa.int64())})

    return compare


def block_links(members: DataFrame, texts: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """Links that span the classes of (cluster, rep, class, bands), by pairs of blocks."""
    sizes = members.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    sizes = stored(sizes, "cluster-sizes")
    placed = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = placed.join(texts, placed["rep"] == texts["doc_id"]).withColumn("other", other)
    paired = paired.select(
        "cluster", "rep", "class", "bands", "text", "block", F.least("block", "other").alias("left"),
        F.greatest("block", "other").alias("right"),
    )
    return paired.groupBy("cluster", "left", "right").applyInArrow(_compare_block(similarity), LINKS)


def near_links(members: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links that span the classes; ``members`` are (cluster, rep, bands)."""
    large = stored(members.groupBy("cluster").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("cluster"), "large")
    own_class = F.col("rep").alias("class")
    if large.isEmpty():
        return block_links(members.select("cluster", "rep", own_class, "bands"), texts, similarity)
    small = members.join(large, "cluster", "left_anti").select("cluster", "rep", own_class, "bands")
    links, still = hub_rounds(members.join(large, "cluster", "left_semi"), texts, similarity)
    left = still.join(members.select("rep", "bands"), "rep").select("cluster", "rep", "class", "bands")
    return links.union(block_links(small.union(left), texts, similarity))


def text_digest(text: Column) -> Column:
    """The digest that :func:`judged_texts` tells texts apart by; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def judged_texts(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: ``doc_id``, ``digest`` of its text, ``class_id``, ``kept``."""
    signed = stored(corpus(docs).mapInArrow(_sign, SIGNATURES), "signatures")
    # copies of a text have equal bands; the numbers hold once they are written
    texts = signed.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("bands").alias("bands"))
    reps = stored(texts.withColumn("rep", F.monotonically_increasing_id()), "representatives")
    buckets = reps.select("rep", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1")
    stars = buckets.join(stored(shared.select("key", "hub"), "buckets"), "key").where("rep <> hub")
    clusters = components(stars, "hub", "rep").select(F.col("vertex").alias("rep"), F.col("component").alias("cluster"))
    members = stored(reps.join(clusters, "rep").select("cluster", "rep", "bands", "first_id", "digest"), "cluster-members")
    wanted = members.select(F.col("rep").alias("number"), "first_id", "digest")
    own = F.col("doc_id").eqNullSafe(F.col("first_id")) & (text_digest(F.col("text")) == F.col("digest"))
    texts = corpus(docs).join(wanted, own).select(F.col("number").alias("doc_id"), "text")
    texts = stored(texts.dropDuplicates(["doc_id"]), "involved-texts")
    members = members.select("cluster", "rep", "bands")
    found = components(near_links(members, texts, similarity), "hub", "rep").select(F.col("vertex").alias("rep"), "component")
    found = stored(reps.select("digest", "rep", "first_id").join(found, "rep"), "linked-texts")
    names = found.groupBy("component").agg(F.min("first_id").alias("class_id"))
    linked = found.join(names, "component").select("digest", F.lit(True).alias("linked"), "class_id")
    named = F.when(F.col("linked"), F.col("class_id")).otherwise(F.col("first_id"))
    classes = reps.select("digest", "first_id").join(linked, "digest", "left").select("digest", named.alias("class_id"))
    classes = stored(classes, "classes")
    class_id = F.when(F.col("bands").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    kept = F.col("class_id").isNull() | F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False))
    judged = signed.join(classes, "digest").select("doc_id", "digest", class_id.alias("class_id"))
    return judged.withColumn("kept", kept)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (smallest id of its class), ``kept``."""
    return judged_texts(docs, similarity).drop("digest")
