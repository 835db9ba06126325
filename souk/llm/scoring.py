"""Language-model scores of texts from a sharded Elias-Fano n-gram trie.

Tokens are the words of a text and an end mark. The base model is the smoothed unigram model over all
training tokens. The scoring model discounts the counts of all word pairs, however rare, and backs
off to the base: P(v | u) = (c(u, v) - D) / c(u) + backoff(u) * base(v), which sums to one.

The frequent words (``VOCABULARY`` at most) are broadcast; which words these are decides where a pair
is counted, not whether. All else grows with the corpus and is dealt over shards by a hash: pair
counts, the tries built from them, counts of the rarer words, and the texts' questions to them, packed
as sorted differences. A pair of frequent words is in the shard of the pair, a rarer word after a
frequent one in the shard of the successor, and what follows a rarer word in the shard of the context.
Pairs with a rarer word are stored by what they gain over the base, so a text's score is the sum of its
bases, which the successors' shards know, and its gains. Pairs that make up a ``HOT_PAIRS``-th of all
pairs or more are answered where they are met, so no shard gets more than a small share of the tokens.
All values are quantised in the same steps, whose range follows from the number of training tokens, so a
score does not depend on the number of shards.

Defined results: null and empty texts are one token, the end mark; equal rows are scored one by one;
without training text every token has the unseen probability; rows without an id are scored, but have
no remainder: nothing is learned from them and ``held_out`` is null; an empty table gives an empty result.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm import elias_fano
from souk.llm.common import (
    U64, corpus, even_keys, fold, kth_largest, lowered, mixed, numbers, prefix_sums, shards, slices, span_hashes, stored, word_spans,
)

FOLDS, HELD_OUT = 5, 1
VOCABULARY = (1 << 16) - 2
WIDTH = 1 << 17  # contexts and successors are below it
HOT_PAIRS = 4096
DISCOUNT = 0.75
END = U64(0x5DEECE66D1234567)
FLUSH_TOKENS = 2_000_000


def planes(values: np.ndarray) -> bytes:
    """Integers as one run of bytes for each significance, which shuffles compress well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unplanes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def packed(ordered: np.ndarray) -> bytes:
    """A sorted sequence as differences."""
    return planes(np.diff(ordered.astype(U64), prepend=U64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, U64), dtype=U64)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each token: the words of a text, then its end mark."""
    low = lowered(data)
    starts, ends, doc = word_spans(low, offsets)
    n = len(offsets) - 1
    words = np.bincount(doc, minlength=n)
    out = np.full(len(doc) + n, END, U64)
    out[np.arange(len(doc)) + doc] = span_hashes(prefix_sums(low), starts, ends)
    return out, np.repeat(np.arange(n), words + 1)


class Words:
    """The frequent words: sorted hashes with their counts; id = place, and one more for the start."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int, distinct: int, texts: int):
        self.hashes, self.counts = hashes, counts
        self.start = len(hashes)
        self.total, self.norm = total, total + 0.5 * (distinct + 1)
        self.base = np.log10((counts + 0.5) / self.norm)
        # a counted pair keeps at least 1 - DISCOUNT of a context's count, and a word's base is 1.5 / norm at least
        lowest = float(np.log10((1 - DISCOUNT) / max(total, 1)))
        self.probabilities, self.gains = (lowest, 0.0), (lowest, float(np.log10(self.norm / 1.5 + 1)))
        self.context_counts = np.append(counts, texts).astype(float)
        self.backoff = np.zeros(len(hashes) + 1)  # log10, filled in once the pairs are counted
        self.hot_keys = np.zeros(0, U64)
        self.hot_values = np.zeros(0)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Id of each token, -1 for a rarer word."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def contexts(self, ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Id before each token: the start of its text or the previous token's."""
        before = np.full(len(ids), self.start)
        before[1:] = np.where(doc[1:] == doc[:-1], ids[:-1], self.start)
        return before

    def base_of(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / self.norm)

    def backed_off(self, keys: np.ndarray) -> np.ndarray:
        return self.backoff[(keys // U64(WIDTH)).astype(np.int64)] + self.base[(keys % U64(WIDTH)).astype(np.int64)]

    def log_probability(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of the pair model for counted pairs."""
        direct = (counts - DISCOUNT) / self.context_counts[(keys // U64(WIDTH)).astype(np.int64)]
        return np.log10(direct + 10.0 ** self.backed_off(keys))


def _combined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, U64), np.zeros(0, np.int64))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting, held = [], 0

    def rows() -> pa.RecordBatch:
        hashes, counts = _combined(waiting)
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], ["hash", "n"])

    for _, data, offsets in slices(batches):
        waiting.append(tokens(data, offsets)[0])
        held += len(waiting[-1])
        if held >= 2 * FLUSH_TOKENS:
            yield rows()
            waiting, held = [], 0
    yield rows()


def learn_words(training: DataFrame) -> Words:
    """The frequent words."""
    counts = training.mapInArrow(_count_words, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    counts = stored(counts, "word-counts")
    total = counts.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("hash") == int(END.view(np.int64)), F.col("n")))).first()
    if total[1] > VOCABULARY:
        border, _ = kth_largest(counts, "n", VOCABULARY)
        counts_of_frequent = counts.where(F.col("n") > border)
    else:
        counts_of_frequent = counts
    top = counts_of_frequent.toPandas()  # VOCABULARY rows at most
    hashes, n = top["hash"].to_numpy(np.int64).view(U64), top["n"].to_numpy(np.int64)
    order = np.argsort(hashes)
    return Words(hashes[order], n[order], total[0] or 0, total[1], total[2] or 0)


def _by_shard(shard: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by shard, then key, and where each shard's run begins and ends."""
    order = np.lexsort((key, shard))
    return order, np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))


def count_pairs(training: DataFrame, words: Words, keys: list[int]) -> DataFrame:
    """(shard, keys, counts): pairs of frequent words, packed by shard."""
    n_shards, names = len(keys), np.array(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0

        def rows() -> pa.RecordBatch:
            pair, n = _combined(waiting)
            shard = (mixed(pair) % U64(n_shards)).astype(np.int64)
            order, edges = _by_shard(shard, pair)
            runs = [order[a:b] for a, b in zip(edges, edges[1:])]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names[[shard[r[0]] for r in runs]] if runs else [], pa.int64()),
                    pa.array([packed(pair[r]) for r in runs], pa.binary()),
                    pa.array([planes(n[r].astype(np.uint32)) for r in runs], pa.binary()),
                ],
                ["shard", "keys", "counts"],
            )

        for _, data, offsets in slices(batches):
            hashes, doc = tokens(data, offsets)
            ids = words.ids(hashes)
            before = words.contexts(ids, doc)
            both = (ids >= 0) & (before >= 0)
            waiting.append((before[both] * WIDTH + ids[both]).astype(U64))
            held += int(both.sum())
            if held >= FLUSH_TOKENS:
                yield rows()
                waiting, held = [], 0
        yield rows()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        pair = np.concatenate([unpacked(x) for x in group["keys"]])
        n = np.concatenate([unplanes(x, np.uint32) for x in group["counts"]]).astype(np.int64)
        unique, at = np.unique(pair, return_inverse=True)
        total = np.bincount(at, n, len(unique)).astype(np.int64)
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "keys": [packed(unique)], "counts": [planes(total)]})

    dealt = training.mapInArrow(count, "shard long, keys binary, counts binary")
    return stored(dealt.groupBy("shard").applyInPandas(merge, "shard long, keys binary, counts binary"), "pair-counts")


RARE_PAIRS = "shard long, kind int, keys binary, others binary, counts binary"
SUCCESSOR, CONTEXT = range(5, 7)  # the word whose shard has the pair


def _merged(anchors: np.ndarray, others: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs in order, each once, with its sum of counts."""
    order = np.lexsort((others, anchors))
    anchors, others = anchors[order], others[order]
    new = np.ones(len(order), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (others[1:] != others[:-1])
    firsts = np.flatnonzero(new)
    return anchors[firsts], others[firsts], np.add.reduceat(counts[order], firsts) if len(firsts) else counts[:0]


def _joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts])


def rare_pairs(words: Words, hashes: np.ndarray, ids: np.ndarray, before: np.ndarray):
    """(successor, context) of the rarer tokens, (context, successor) of tokens after one; places of both.

    The second of a pair is the id of a frequent word or the hash of a rarer one.
    """
    previous = np.concatenate([hashes[:1], hashes[:-1]])
    rare, after = np.flatnonzero(ids < 0), np.flatnonzero(before < 0)
    contexts = np.where(before[rare] >= 0, before[rare].astype(U64), previous[rare])
    successors = np.where(ids[after] >= 0, ids[after].astype(U64), hashes[after])
    return (hashes[rare], contexts, rare), (previous[after], successors, after)


def count_rare_pairs(training: DataFrame, words: Words, keys: list[int]) -> DataFrame:
    """Pairs with a rarer word: by the successor if that is rarer, by the context otherwise."""
    n_shards, names = len(keys), np.array(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = {SUCCESSOR: [], CONTEXT: []}, 0

        def rows() -> pa.RecordBatch:
            out = []
            for kind, parts in waiting.items():
                anchors, others = (_joined([part[i] for part in parts], U64) for i in range(2))
                anchors, others, n = _merged(anchors, others, np.ones(len(anchors), np.int64))
                shard = (anchors % U64(n_shards)).astype(np.int64)
                order, edges = _by_shard(shard, anchors)
                for a, b in zip(edges, edges[1:]):
                    run = order[a:b]
                    out.append((int(names[shard[run[0]]]), kind, packed(anchors[run]), planes(others[run]), planes(n[run].astype(np.uint32))))
            return _rare_rows(out)

        for _, data, offsets in slices(batches):
            hashes, doc = tokens(data, offsets)
            ids = words.ids(hashes)
            by_successor, by_context = rare_pairs(words, hashes, ids, words.contexts(ids, doc))
            waiting[SUCCESSOR].append(by_successor[:2])
            known = ids[by_context[2]] >= 0  # the others are counted by their successor first
            waiting[CONTEXT].append((by_context[0][known], by_context[1][known]))
            held += len(by_successor[0]) + int(known.sum())
            if held >= FLUSH_TOKENS:
                yield rows()
                waiting, held = {SUCCESSOR: [], CONTEXT: []}, 0
        yield rows()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind, part in group.groupby("kind"):
            counts = np.concatenate([unplanes(x, np.uint32) for x in part["counts"]]).astype(np.int64)
            others = np.concatenate([unplanes(x, U64) for x in part["others"]])
            anchors, others, n = _merged(np.concatenate([unpacked(x) for x in part["keys"]]), others, counts)
            out.append((group["shard"].iloc[0], kind, packed(anchors), planes(others), planes(n)))
        return pd.DataFrame(out, columns=["shard", "kind", "keys", "others", "counts"])

    dealt = training.mapInArrow(count, RARE_PAIRS)
    return stored(dealt.groupBy("shard").applyInPandas(merge, RARE_PAIRS), "rare-pair-counts")


def _rare_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    names = [part.split()[0] for part in RARE_PAIRS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], names)


def _rare_of(batch: pa.RecordBatch, kind: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Shard, first words, second words and counts of the rows of one kind."""
    for shard, of, keys, others, counts in zip(*(batch.column(i).to_pylist() for i in range(5))):
        if of == kind:
            yield shard, unpacked(keys), unplanes(others, U64), unplanes(counts, np.int64)


def fit_backoff(words: Words, pairs: DataFrame, rare: DataFrame) -> None:
    """Mass that each frequent context leaves to the base model, and the pairs answered without a shard."""
    columns = ["context", "n", "kinds"]

    def summed(context: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        context, at = np.unique(context.astype(np.int64), return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(context), pa.array(np.bincount(at, n).astype(np.int64)), pa.array(np.bincount(at).astype(np.int64))], columns
        )

    def masses_of_rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, contexts, n in _rare_of(batch, SUCCESSOR):
                frequent = contexts <= U64(words.start)
                yield summed(contexts[frequent], n[frequent])

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                yield summed(unpacked(keys) // U64(WIDTH), unplanes(counts, np.int64))

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                pair, n = unpacked(keys), unplanes(counts, np.int64)
                top = n * HOT_PAIRS >= total  # so there are HOT_PAIRS at most
                yield pa.RecordBatch.from_arrays([pa.array(pair[top].view(np.int64)), pa.array(n[top])], ["pair", "n"])

    schema = ", ".join(f"{name} long" for name in columns)
    both = pairs.mapInArrow(masses, schema).union(rare.mapInArrow(masses_of_rare, schema))
    kept = both.groupBy("context").agg(F.sum("n"), F.sum("kinds"))
    table = np.array([tuple(r) for r in kept.collect()], np.int64).reshape(-1, 3)  # a row per frequent word at most
    left = np.ones(len(words.backoff))
    left[table[:, 0]] = 1 - (table[:, 1] - DISCOUNT * table[:, 2]) / words.context_counts[table[:, 0]]
    words.backoff = np.log10(np.maximum(left, 1e-12))
    total = int(table[:, 1].sum())
    hot = pairs.mapInArrow(often, "pair long, n long").toPandas()
    keys = hot["pair"].to_numpy(np.int64).view(U64)
    order = np.argsort(keys)
    words.hot_keys = keys[order]
    if len(keys):  # as a trie has them
        steps = elias_fano.quantised(words.log_probability(keys, hot["n"].to_numpy(float)), *words.probabilities)
        words.hot_values = elias_fano.restored(steps, *words.probabilities)[order]


MESSAGE = "shard long, kind int, flush long, keys binary, docs binary, numbers binary"
LOCAL, PAIRS, TRIE, OF_SUCCESSORS, OF_CONTEXTS = range(5)


def _message(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    names = [part.split()[0] for part in MESSAGE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names)


def build_tries(pairs: DataFrame, words: Words) -> DataFrame:
    """One Elias-Fano trie per shard."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                pair, n = unpacked(keys), unplanes(counts, np.int64)
                context, successor = (pair // U64(WIDTH)).astype(np.int64), (pair % U64(WIDTH)).astype(np.int64)
                value = words.log_probability(pair, n.astype(float))
                yield _message([(shard, TRIE, 0, elias_fano.trie(context, successor, value, WIDTH, words.probabilities), None, None)])

    return pairs.mapInArrow(build, MESSAGE)


def _rare_trie(
    words: Words, shard: int, kind: int, first: np.ndarray, at: np.ndarray, others: np.ndarray, gain: np.ndarray, per_first: np.ndarray
) -> tuple:
    """A trie over the places of a shard's words, with those words and a number for each first one."""
    second, successor = np.unique(others, return_inverse=True)
    trie = elias_fano.trie(at, successor, gain, len(second) + 1, words.gains)
    return shard, kind, 0, trie, packed(first) + packed(second), per_first.tobytes()


def build_rare_tries(rare: DataFrame, words: Words, keys: list[int]) -> DataFrame:
    """Per shard the gains after frequent words, by successor, and after rarer words, by context."""
    n_shards, names = len(keys), np.array(keys)
    schema = RARE_PAIRS + ", totals binary"

    def by_successor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, anchors, contexts, n in _rare_of(batch, SUCCESSOR):
                first, at = np.unique(anchors, return_inverse=True)
                totals = np.bincount(at, n).astype(np.int64)  # each token has one context, so this is the word's count
                frequent = contexts <= U64(words.start)  # what follows a rarer word is in that word's shard
                at, n, context = at[frequent], n[frequent], contexts[frequent].astype(np.int64)
                direct = (n - DISCOUNT) / words.context_counts[context]
                gain = np.log10(direct / 10.0 ** words.base_of(totals[at]) + 10.0 ** words.backoff[context])
                yield _message([_rare_trie(words, shard, OF_SUCCESSORS, first, at, contexts[frequent], gain, totals)])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(shard, anchors, others, n, None) for shard, anchors, others, n in _rare_of(batch, CONTEXT)]
            for _, anchors, contexts, n in _rare_of(batch, SUCCESSOR):
                _, at = np.unique(anchors, return_inverse=True)
                totals = np.bincount(at, n).astype(np.int64)[at]
                rarer = np.flatnonzero(contexts > U64(words.start))
                shard = (contexts[rarer] % U64(n_shards)).astype(np.int64)
                order, edges = _by_shard(shard, contexts[rarer])
                for a, b in zip(edges, edges[1:]):
                    run = rarer[order[a:b]]
                    parts.append((int(names[shard[order[a]]]), contexts[run], anchors[run], n[run], totals[run]))
            rows = _rare_rows([(shard, CONTEXT, packed(anchors), planes(others), planes(n)) for shard, anchors, others, n, _ in parts])
            yield rows.append_column("totals", pa.array([None if totals is None else planes(totals) for *_, totals in parts], pa.binary()))

    def by_context(group: pd.DataFrame) -> pd.DataFrame:
        anchors = np.concatenate([unpacked(x) for x in group["keys"]])
        others = np.concatenate([unplanes(x, U64) for x in group["others"]])
        n = np.concatenate([unplanes(x, np.int64) for x in group["counts"]])
        # frequent successors' bases are known, the others' counts came with them
        base = np.concatenate([
            words.base[unplanes(x, U64).astype(np.int64)] if totals is None else words.base_of(unplanes(totals, np.int64))
            for x, totals in zip(group["others"], group["totals"])
        ])
        order = np.lexsort((others, anchors))
        anchors, others, n, base = anchors[order], others[order], n[order], base[order]
        first, at = np.unique(anchors, return_inverse=True)
        total = np.bincount(at, n)  # each token but the end mark has one successor, so this is the word's count
        backoff = DISCOUNT * np.bincount(at) / total
        gain = np.log10((n - DISCOUNT) / (total[at] * 10.0**base) + backoff[at])
        row = _rare_trie(words, group["shard"].iloc[0], OF_CONTEXTS, first, at, others, gain, np.log10(backoff))
        return pd.DataFrame([row], columns=[part.split()[0] for part in MESSAGE.split(", ")])

    after_rare = rare.mapInArrow(dealt, schema).groupBy("shard").applyInPandas(by_context, MESSAGE)
    return rare.mapInArrow(by_successor, MESSAGE).union(after_rare)


class RareTrie:
    """What a shard knows of its rarer words."""

    def __init__(self, rows: pd.DataFrame, path: str):
        self.per_anchor = np.zeros(0)
        for r in rows.itertuples():
            self.per_anchor = np.frombuffer(r.numbers, np.int64 if r.kind == OF_SUCCESSORS else float)
            size = 8 * len(self.per_anchor)
            self.first, self.second = unpacked(r.docs[:size]), unpacked(r.docs[size:])
            with open(path, "wb") as file:
                file.write(r.keys)
            self.trie = elias_fano.Trie(path, len(self.second) + 1)

    def find(self, anchors: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Whether each first word is known, its number, whether the pair is stored, and its gain."""
        if not len(self.per_anchor):
            none = np.zeros(len(anchors))
            return none > 0, none, none > 0, none
        at = np.minimum(np.searchsorted(self.first, anchors), len(self.first) - 1)
        known = self.first[at] == anchors
        place = np.searchsorted(self.second, others)
        place[place == len(self.second)] = 0
        found, gain = self.trie.find(at, place)
        found[found] = known[found] & (self.second[place[found]] == others[found])
        return known, np.where(known, self.per_anchor[at], 0), found, gain


def ask(docs: DataFrame, words: Words, keys: list[int]) -> DataFrame:
    """Per group of texts: what is known at once, and questions to the shards."""
    n_shards, names = len(keys), np.array(keys)

    def flush(key: int, ids: list, sums: list, pairs: list, rare: dict) -> pa.RecordBatch:
        local = np.concatenate(sums, axis=1).astype(float)  # all are integers where no word is frequent
        doc_ids, missing = (np.concatenate(x) for x in zip(*ids))
        named = doc_ids.tobytes() + (np.packbits(missing).tobytes() if missing.any() else b"")
        rows = [(int(names[key % n_shards]), LOCAL, key, named, None, local.tobytes())]
        for kind, parts in ((PAIRS, pairs), *rare.items()):
            asked, other, doc = (np.concatenate(x) for x in zip(*parts))
            spread = mixed(asked) if kind == PAIRS else asked
            shard = (spread % U64(n_shards)).astype(np.int64)
            order, edges = _by_shard(shard, asked)
            for a, b in zip(edges, edges[1:]):
                run = order[a:b]
                others = None if kind == PAIRS else planes(other[run])
                rows.append((int(names[shard[run[0]]]), kind, key, packed(asked[run]), planes(doc[run].astype(np.uint32)), others))
        return _message(rows)

    def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        ids, sums, pairs, rare, held, first = [], [], [], {SUCCESSOR: [], CONTEXT: []}, 0, 0
        for batch, data, offsets in slices(batches):
            n = batch.num_rows
            hashes, doc = tokens(data, offsets)
            word = words.ids(hashes)
            before = words.contexts(word, doc)
            common = word >= 0
            base = np.bincount(doc[common], words.base[word[common]], n)
            score = np.bincount(doc[common & (before < 0)], words.base[word[common & (before < 0)]], n)
            both = common & (before >= 0)
            key, owner = (before[both] * WIDTH + word[both]).astype(U64), doc[both]
            if len(words.hot_keys):
                at = np.minimum(np.searchsorted(words.hot_keys, key), len(words.hot_keys) - 1)
                hot = words.hot_keys[at] == key
                score = score + np.bincount(owner[hot], words.hot_values[at[hot]], n)
                key, owner = key[~hot], owner[~hot]
            sums.append(np.stack([np.bincount(doc, minlength=n), np.bincount(doc[common], minlength=n), base, score]))
            ids.append((batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)))
            pairs.append((key, key, owner + first))
            for kind, (anchors, others, at) in zip(rare, rare_pairs(words, hashes, word, before)):
                if kind == SUCCESSOR:  # gains after rarer contexts come from those
                    others = np.minimum(others, U64(words.start + 1))
                rare[kind].append((anchors, others, doc[at] + first))
            first += n
            held += len(hashes)
            if held >= FLUSH_TOKENS:
                yield flush(part << 24 | count, ids, sums, pairs, rare)
                ids, sums, pairs, rare, held, first = [], [], [], {SUCCESSOR: [], CONTEXT: []}, 0, 0
                count += 1
        if ids:
            yield flush(part << 24 | count, ids, sums, pairs, rare)

    return docs.mapInArrow(questions, MESSAGE)


ANSWER = "flush long, ids binary, docs binary, sums binary"


def answer(words: Words):
    """Answers of one shard: sums of known, base and score per text asked about."""

    def answered(group: pd.DataFrame) -> pd.DataFrame:
        of = {kind: group[group["kind"] == kind] for kind in range(7)}
        rows = [(r.flush, r.keys, None, r.numbers) for r in of[LOCAL].itertuples()]

        def add(flush: int, doc: np.ndarray, *sums: np.ndarray) -> None:
            texts, at = np.unique(doc, return_inverse=True)
            rows.append((flush, None, planes(texts), np.stack([np.bincount(at, x) for x in sums]).astype(float).tobytes()))

        with tempfile.NamedTemporaryFile() as file:
            file.write(of[TRIE]["keys"].iloc[0] if len(of[TRIE]) else elias_fano.trie(*(np.zeros(0, np.int64),) * 3, WIDTH))
            file.flush()
            trie = elias_fano.Trie(file.name, WIDTH)
            for r in of[PAIRS].itertuples():
                key, doc = unpacked(r.keys), unplanes(r.docs, np.uint32)
                found, value = trie.find((key // U64(WIDTH)).astype(np.int64), (key % U64(WIDTH)).astype(np.int64))
                value = np.where(found, value, words.backed_off(key))
                add(r.flush, doc, np.zeros(len(doc)), np.zeros(len(doc)), value)
        backoff = np.append(words.backoff, 0.0)
        with tempfile.NamedTemporaryFile() as file:
            model = RareTrie(of[OF_SUCCESSORS], file.name)
            for r in of[SUCCESSOR].itertuples():
                context, doc = unplanes(r.numbers, U64), unplanes(r.docs, np.uint32)
                known, n, found, gain = model.find(unpacked(r.keys), context)
                base = words.base_of(n)
                add(r.flush, doc, known, base, base + np.where(found, gain, backoff[context.astype(np.int64)]))
        with tempfile.NamedTemporaryFile() as file:
            model = RareTrie(of[OF_CONTEXTS], file.name)
            for r in of[CONTEXT].itertuples():
                _, left, found, gain = model.find(unpacked(r.keys), unplanes(r.numbers, U64))
                doc = unplanes(r.docs, np.uint32)
                add(r.flush, doc, np.zeros(len(doc)), np.zeros(len(doc)), np.where(found, gain, left))
        return pd.DataFrame(rows, columns=["flush", "ids", "docs", "sums"])

    return answered


SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _collected(group: pd.DataFrame) -> pd.DataFrame:
    """The texts of one group with all their answers."""
    local = group[group["ids"].notna()].iloc[0]
    total = np.frombuffer(local["sums"], float).reshape(4, -1).copy()
    n = total.shape[1]
    values, marks = np.frombuffer(local["ids"], np.int64, n), np.frombuffer(local["ids"], np.uint8, offset=8 * n)
    missing = np.unpackbits(marks, count=n).astype(bool) if len(marks) else np.zeros(n, bool)
    doc_ids = pd.arrays.IntegerArray(values.copy(), missing)
    for docs, sums in zip(group["docs"], group["sums"]):
        if docs is not None:
            total[1:, unplanes(docs, np.uint32)] += np.frombuffer(sums, float).reshape(3, -1)
    return pd.DataFrame(
        {"doc_id": doc_ids, "n_tokens": total[0].astype(np.int64), "n_known": total[1].astype(np.int64), "base_score": total[2], "score": total[3]}
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """Learn from all folds but the held-out one, score every text."""
    spark = docs.sparkSession
    texts = corpus(docs)
    keys = even_keys(spark, shards(spark))
    training = texts.where(fold("doc_id", FOLDS) != HELD_OUT)
    words = learn_words(training)
    pairs, rare = count_pairs(training, words, keys), count_rare_pairs(training, words, keys)
    fit_backoff(words, pairs, rare)
    messages = ask(texts, words, keys).union(build_tries(pairs, words)).union(build_rare_tries(rare, words, keys))
    answers = messages.groupBy("shard").applyInPandas(answer(words), ANSWER)
    scores = answers.groupBy("flush").applyInPandas(_collected, SCORES)
    return scores.select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
        F.lit(words.total).cast("long").alias("train_tokens"), "base_score", "score",
    )
