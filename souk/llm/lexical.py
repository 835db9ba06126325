"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds blocks of documents of like size. A block is a matrix of bits: a row (slice) per place of
the Bloom filter, a column per document. A term of a query is present at most where all its slices
have a bit, so the AND of a few slices, weighted and summed over the terms, bounds the scores of
a block's documents from above. A term that occurs twice, three times or five times is entered once more for
each of these levels, which bounds its frequency too.

Ranking takes two rounds: the documents with the highest bounds are scored exactly, which gives the score to
beat; then every document whose bound is not below that is scored exactly. Nothing else is left out, but copies of
one text beyond the k smallest ids, which k others of equal score precede.

Queries are taken in blocks of a bounded size. Terms are compared by 64-bit hashes.

Defined results: a null text has no terms; rows with one id rank as documents of their own, rows without
an id behind others of the same score; each row of the items is ranked for itself; items without terms,
empty items and an empty corpus give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.llm.common import U64, byte_column, lowered, mixed, numbers, prefix_sums, slices, span_hashes, stored

IN_TERM = np.zeros(256, bool)
IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LEVELS = (1, 2, 3, 5)  # frequencies with entries of their own
BITS, HASHES = 8, 3  # places per entry, slices per term
BLOCK, BLOCK_BITS = 256, 1 << 26  # documents of a block, and bits at which a block is closed earlier
ITEMS, ITEM_CHARS = 256, 1 << 20  # queries taken together
NO_ID = np.iinfo(np.int64).max  # stands behind every id


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each term, and the text it stands in."""
    inside = IN_TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    return span_hashes(prefix_sums(lowered(data)), starts, ends), text


def counted_terms(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, term) in order of the text: term, text, frequency."""
    order = np.argsort(hashes)
    order = order[np.argsort(text[order].astype(np.uint16 if len(text) and text[-1] < 1 << 16 else np.int64), kind="stable")]
    hashes, text = hashes[order], text[order]
    first = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])])[: len(hashes)])
    return hashes[first], text[first], np.diff(np.append(first, len(hashes)))


def places(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """The slices of each term at one level of frequency: an array (terms, HASHES)."""
    seeds = (np.arange(HASHES, dtype=np.uint64) + U64(HASHES * level + 1)) * U64(0xD6E8FEB86659FD93)
    return (mixed(hashes[:, None] ^ seeds[None, :]) & U64(width - 1)).astype(np.int64)


def width_for(entries: int) -> int:
    return BITS << max(3, int(entries - 1).bit_length())


INDEX = (
    "ids array<long>, keys array<long>, copies array<long>, sizes array<long>, tops array<long>, n_docs long, n_terms long, "
    "width long, slices binary, terms binary, holders binary"
)
INDEX_FIELDS = [part.split(" ")[0] for part in INDEX.split(", ")]
INDEX_TYPES = {"array<long>": pa.list_(pa.int64()), "long": pa.int64(), "binary": pa.large_binary()}


def _index_row(**values) -> pa.RecordBatch:
    types = [INDEX_TYPES[part.split(" ")[1]] for part in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([values.get(n)], t) for n, t in zip(INDEX_FIELDS, types)], INDEX_FIELDS)


@dataclass
class Document:
    id: int | None
    key: int
    copy: int
    size: int
    top: int
    entries: list[np.ndarray]  # the terms of each level


def block_row(docs: list[Document], width: int) -> pa.RecordBatch:
    matrix = np.zeros((width, -(-len(docs) // 8)), np.uint8)
    for column, doc in enumerate(docs):
        bit = np.uint8(128 >> (column & 7))
        for level, terms in enumerate(doc.entries):
            rows = places(terms, level, width).ravel()
            matrix[rows, column >> 3] |= bit
    return _index_row(
        ids=[d.id for d in docs], keys=[d.key for d in docs], copies=[d.copy for d in docs], sizes=[d.size for d in docs],
        tops=[d.top for d in docs], n_docs=sum(d.size > 0 for d in docs), n_terms=sum(d.size for d in docs),
        width=width, slices=matrix.tobytes(),
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with a key of the row, by which candidates are found again, and one of the text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("key"), F.xxhash64("text").alias("copy")
    )


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index: blocks of signatures, and per slice of texts how many of them hold each term."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[Document]] = {}
        for part, data, offsets in slices(batches):
            hashes, text = term_hashes(data, offsets)
            n = part.num_rows
            sizes = np.bincount(text, minlength=n)
            terms, owner, times = counted_terms(hashes, text)
            held, holders = np.unique(terms, return_counts=True)
            yield _index_row(terms=held.tobytes(), holders=holders.astype(np.uint32).tobytes())
            bounds = np.searchsorted(owner, np.arange(n + 1))
            ids = part.column(0).to_pylist()
            keys, copies = (numbers(part, name).tolist() for name in ("key", "copy"))
            for k in range(n):
                own, often = terms[bounds[k] : bounds[k + 1]], times[bounds[k] : bounds[k + 1]]
                entries = [own[often >= level] for level in LEVELS]
                doc = Document(ids[k], keys[k], copies[k], int(sizes[k]), int(often.max(initial=0)), entries)
                width = width_for(sum(map(len, entries)))
                group = waiting.setdefault(width, [])
                group.append(doc)
                if len(group) >= BLOCK or len(group) % 8 == 0 and len(group) * width >= BLOCK_BITS:
                    yield block_row(waiting.pop(width), width)
        for width, group in waiting.items():
            yield block_row(group, width)

    return stored(_keyed(docs).mapInArrow(work, INDEX), "signatures")


@dataclass
class Queries:
    """A block of items: their distinct terms in hash order, and which item has which."""

    ids: pa.Array
    terms: np.ndarray
    has: list[np.ndarray]  # per item the numbers of its terms
    weights: np.ndarray | None = None
    n_docs: int = 0
    n_terms: int = 0

    @classmethod
    def of(cls, rows: list[Row], id_type: pa.DataType) -> Queries:
        texts = pa.RecordBatch.from_arrays([pa.array([r["text"] for r in rows], pa.string())], ["text"])
        data, offsets = byte_column(texts)
        hashes, text = term_hashes(data, offsets)
        terms, owner, _ = counted_terms(hashes, text)
        distinct, number = np.unique(terms, return_inverse=True)
        bounds = np.searchsorted(owner, np.arange(len(rows) + 1))
        return cls(
            pa.array([r["item_id"] for r in rows], id_type), distinct,
            [number[bounds[i] : bounds[i + 1]] for i in range(len(rows))],
        )

    def weigh(self, holders: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holders], np.int64)
        self.n_docs, self.n_terms = n_docs, n_terms

    def matrix(self) -> np.ndarray:
        """Weights as (items, terms); sums of a row are exact in the type chosen."""
        most = max((int(self.weights[t].sum()) for t in self.has), default=0)
        out = np.zeros((len(self.has), len(self.terms)), np.float32 if most < 1 << 24 else np.float64)
        for item, terms in enumerate(self.has):
            out[item, terms] = self.weights[terms]
        return out

    def shares(self, frequency: np.ndarray, size: np.ndarray) -> np.ndarray:
        """What a term's weight is multiplied with, from its frequency and the document's number of terms."""
        return (1_000_000_000 * frequency) // (1000 * frequency + 20 * (50 + self._lengths(size)))

    def _lengths(self, size: np.ndarray) -> np.ndarray:
        if len(size) and int(size.max()) * 50 * self.n_docs < 1 << 62:
            return (50 * self.n_docs * size) // self.n_terms
        return np.array([(50 * s * self.n_docs) // self.n_terms for s in size.tolist()], np.int64)


def holders_of(index: DataFrame, queries: Queries) -> np.ndarray:
    """How many documents hold each term of the queries."""
    wanted = queries.terms

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for terms, holders in zip(batch.column(0), batch.column(1)):
                held = np.frombuffer(terms.as_py(), np.uint64)
                if len(held):
                    at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
                    total += np.where(held[at] == wanted, np.frombuffer(holders.as_py(), np.uint32)[at], 0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(wanted))), pa.array(total)], ["term", "n"])

    partial = index.where("terms is not null").select("terms", "holders").mapInArrow(work, "term long, n long")
    found = np.zeros(len(wanted), np.int64)
    for row in partial.groupBy("term").agg(F.sum("n").alias("n")).collect():  # the terms of one block of items
        found[row["term"]] = row["n"]
    return found


def block_bounds(row: dict, queries: Queries, weights: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores, as (items, documents)."""
    sizes, tops = np.array(row["sizes"], np.int64), np.array(row["tops"], np.int64)
    width, n = row["width"], len(sizes)
    matrix = np.frombuffer(row["slices"], np.uint8).reshape(width, -1)
    uppers = [*(np.minimum(level - 1, tops) for level in LEVELS[1:]), tops]
    total, before, present = np.zeros((len(weights), n), np.int64), np.zeros(n, np.int64), None
    for level, upper in enumerate(uppers):
        found = np.bitwise_and.reduce(matrix[places(queries.terms, level, width)], axis=1)
        present = found if present is None else present & found
        used = np.flatnonzero(present.any(axis=1))
        if not len(used):
            break
        bits = np.unpackbits(present[used], axis=1)[:, :n].astype(weights.dtype)
        share = queries.shares(upper, sizes)
        total += (weights[:, used] @ bits).astype(np.int64) * (share - before)
        before = share
    return total


def first_of_items(item: np.ndarray, score: np.ndarray, id: np.ndarray, k: int) -> np.ndarray:
    """The rows with the k highest scores of each item, the smaller id first."""
    order = np.lexsort((id, -score, item))
    begins = np.flatnonzero(np.diff(item[order], prepend=-1) != 0)
    rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    return order[rank < k]


def first_copies(item: np.ndarray, copy: np.ndarray, id: np.ndarray, k: int) -> np.ndarray:
    """Of the copies of a text that an item meets, those with the k smallest ids."""
    order = np.lexsort((id, copy, item))
    new = (np.diff(item[order], prepend=-1) != 0) | (np.diff(copy[order], prepend=0) != 0)
    new[:1] = True
    begins = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    return order[rank < k]


def _ids(values: list) -> np.ndarray:
    return np.array([NO_ID if x is None else x for x in values], np.int64)


BOUNDS_READ = ["ids", "keys", "copies", "sizes", "tops", "width", "slices"]
GATHERED = 1 << 18


def candidates(index: DataFrame, queries: Queries, k: int, limits: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """Rows ``item, key, bound`` worth scoring.

    Without ``limits`` the k highest bounds of each item and task; with them (per item the score
    to beat and the id of the document that has it) every document that could come before.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = queries.matrix()
        held = [np.zeros(0, np.int64)] * 5  # item, bound, id, copy, key

        def thinned(x: list[np.ndarray]) -> list[np.ndarray]:
            kept = first_of_items(x[0], x[1], x[2], k) if limits is None else first_copies(x[0], x[3], x[2], k)
            return [column[kept] for column in x]

        def gather(rows: list[list[np.ndarray]]) -> list[np.ndarray]:
            return thinned([np.concatenate(x) for x in zip(held, *rows)])

        new, size = [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                bound = block_bounds(row, queries, weights)
                id, keys, copies = _ids(row["ids"]), np.array(row["keys"], np.int64), np.array(row["copies"], np.int64)
                if limits is None:
                    good = bound > 0
                else:
                    best, best_id = limits
                    good = (bound > best[:, None]) | ((bound == best[:, None]) & (id[None, :] <= best_id[:, None]))
                item, doc = np.nonzero(good)
                new.append([item, bound[item, doc], id[doc], copies[doc], keys[doc]])
                size += len(item)
                if size > GATHERED:
                    held, new, size = gather(new), [], 0
        held = gather(new)
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[4]), pa.array(held[1])], ["item", "key", "bound"])

    return index.where("width is not null").select(*BOUNDS_READ).mapInArrow(work, "item long, key long, bound long")


def scored(docs: DataFrame, found: DataFrame, queries: Queries, k: int) -> DataFrame:
    """Exact scores ``item, rank, doc_id, score`` of candidates; a task sends at most k rows per item."""
    asked = found.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))  # at most the items of a block
    rows = _keyed(docs).join(asked, "key").select("doc_id", "text", "items")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3  # item, score, id
        many = len(queries.terms)
        for part, data, offsets in slices(batches):
            hashes, text = term_hashes(data, offsets)
            sizes = np.bincount(text, minlength=part.num_rows).astype(np.int64)
            at = np.minimum(np.searchsorted(queries.terms, hashes), many - 1)
            hit = queries.terms[at] == hashes
            pair, times = np.unique(text[hit] * many + at[hit], return_counts=True)
            owner, term = pair // many, pair % many
            worth = queries.weights[term] * queries.shares(times, sizes[owner])
            bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
            ids, wanted = _ids(part.column(0).to_pylist()), part.column(2).to_pylist()
            gained = np.zeros(many, np.int64)
            new = []
            for n in range(part.num_rows):
                own = slice(bounds[n], bounds[n + 1])
                gained[term[own]] = worth[own]
                new += [(i, s, ids[n]) for i in wanted[n] if (s := int(gained[queries.has[i]].sum())) > 0]
                gained[term[own]] = 0
            joined = [np.concatenate([x, np.array(y, np.int64)]) for x, y in zip(held, zip(*new))] if new else held
            kept = first_of_items(*joined, k)
            held = [x[kept] for x in joined]
        item, score, id = held
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), queries.ids.take(pa.array(item)), pa.array(id, mask=id == NO_ID), pa.array(score)],
            ["item", "item_id", "doc_id", "score"],
        )

    id_type = {pa.int64(): "long", pa.int32(): "int"}.get(queries.ids.type, "string")
    scores = rows.mapInArrow(work, f"item long, item_id {id_type}, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def item_blocks(items: DataFrame) -> Iterator[list[Row]]:
    """The items a few at a time."""
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append(row)
        size += len(row["text"] or "")
        if len(block) >= ITEMS or size >= ITEM_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def rank_block(docs: DataFrame, index: DataFrame, queries: Queries, k: int) -> DataFrame:
    """The k best documents of each item of one block."""
    first = candidates(index, queries, k, None)
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "key")
    highest = first.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    best, best_id = np.ones(len(queries.has), np.int64), np.full(len(queries.has), NO_ID)
    for row in scored(docs, highest, queries, k).where(F.col("rank") == k).collect():  # one row per item of the block
        best[row["item"]] = row["score"]
        best_id[row["item"]] = NO_ID if row["doc_id"] is None else row["doc_id"]
    rest = candidates(index, queries, k, (best, best_id))
    return scored(docs, rest, queries, k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``."""
    spark = docs.sparkSession
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    index = build_index(docs)
    totals = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    id_type = {"bigint": pa.int64(), "int": pa.int32()}.get(items.schema["item_id"].dataType.simpleString(), pa.string())
    ranked = []
    for rows in item_blocks(items):
        queries = Queries.of(rows, id_type)
        if totals["l"] and len(queries.terms):
            queries.weigh(holders_of(index, queries), totals["n"], totals["l"])
            result = rank_block(docs, index, queries, k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
            ranked.append(stored(result, "ranked"))
    if not ranked:
        schema = StructType([items.schema["item_id"]]).simpleString()[len("struct<") : -1].replace(":", " ")
        return spark.createDataFrame([], f"{schema}, rank int, doc_id long, score long")
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionByName(more)
    return out
