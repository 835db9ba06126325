"""Language identification with bit-sliced Bloom filters of byte n-grams.

A cell of the filter has one bit per language, in words of 64 bits at most; the cells of an n-gram, combined by AND, are a mask of
all languages that may contain it. For each text the bits are counted per language, the counts are
corrected for the filters' false positives, and the language with the largest share wins.

An n-gram belongs to a language if its rate there is at least ``MIN_SHARE`` of its highest rate in any
language, so that stray foreign passages do not count; how often it occurs does not matter. Tasks set the
bits of their n-grams and the parts are combined by OR: no list of n-grams leaves the executors, and the
filter has at most ``1 << MAX_BITS`` cells, beyond which only its false positives (which are corrected) grow.

Defined results: rows without an id are no training texts and have a null ``held_out``; ``und`` with score 0 for a null text or one without a letter, and for all texts
if nothing could be learned; ties go to the first language by name; a text with letters but no known
n-gram gets the first language with score 0; equal rows are judged alike; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import U64, corpus, fold, lowered, mixed, numbers, slices, stored

FOLDS, HELD_OUT = 3, 1
MIN_SHARE = 0.1
HASHES = 3
CELLS_PER_ENTRY = 12
MAX_BITS = 24
PART = 1 << 14  # cells in one part of the filter
WORD = 64  # languages in one word of a cell
UNDETERMINED = "und"

LETTER = np.zeros(256, bool)
LETTER[ord("a") : ord("z") + 1] = True
LETTER[0x80:] = True


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All four-byte n-grams of each text, padded by a space, with the number of their text.

    A-Z is lower-cased, other ASCII becomes a space; n-grams with two spaces in a row are left out.
    """
    lengths = np.diff(offsets)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    low = lowered(data)
    padded = np.full(len(data) + 2 * len(lengths), 32, np.uint8)
    padded[np.arange(len(data)) + 2 * text_of + 1] = np.where(LETTER[low], low, 32)
    owner = np.repeat(np.arange(len(lengths)), lengths + 2)
    if len(padded) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    blank = padded == 32
    pair = blank[:-1] & blank[1:]
    good = ~(pair[:-2] | pair[1:-1] | pair[2:]) & (owner[:-3] == owner[3:])
    b = padded.astype(np.uint32)
    keys = b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]
    return keys[good], owner[:-3][good]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language and n-gram, combined within the task."""
    names: dict[str, int] = {}
    total: tuple[np.ndarray, np.ndarray] = (np.zeros(0, U64), np.zeros(0, np.int64))
    waiting: list[np.ndarray] = []

    def combine() -> tuple[np.ndarray, np.ndarray]:
        fresh, counts = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (np.zeros(0, U64), np.zeros(0, np.int64))
        keys, at = np.unique(np.concatenate([total[0], fresh]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([total[1], counts]), len(keys)).astype(np.int64)

    for batch, data, offsets in slices(batches):
        codes = np.array([names.setdefault(x, len(names)) for x in batch.column(2).to_pylist()], U64)
        keys, owner = grams(data, offsets)
        waiting.append(codes[owner] << U64(32) | keys.astype(U64))
        if len(waiting) == 8:
            total, waiting = combine(), []
    keys, counts = combine()
    by_code = pa.array(list(names), pa.string())
    if len(keys):
        yield pa.RecordBatch.from_arrays(
            [by_code.take(pa.array((keys >> U64(32)).astype(np.int64))), pa.array((keys & U64(0xFFFFFFFF)).astype(np.int64)), pa.array(counts)],
            ["lang", "gram", "n"],
        )


def places(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The cells of each n-gram."""
    spread = mixed(keys.astype(U64) + U64(1))
    for i in range(HASHES):
        own = spread >> U64(21 * i) if bits <= 21 else mixed(spread + U64(i))
        yield (own & U64((1 << bits) - 1)).astype(np.int64)


def cell_type(languages: int) -> type:
    return next(t for size, t in ((8, np.uint8), (16, np.uint16), (32, np.uint32), (64, U64)) if min(languages, WORD) <= size)


class LanguageFilter:
    """The filter: one mask per cell, bit ``l % WORD`` of its word ``l // WORD`` for language ``l``."""

    def __init__(self, languages: list[str], cells: np.ndarray):
        self.languages, self.cells = languages, cells
        self.bits = cells.shape[1].bit_length() - 1
        kind = cells.dtype.type
        filled = [float((cells[i // WORD] >> kind(i % WORD) & kind(1)).mean()) for i in range(len(languages))]
        self.false_rate = np.array(filled) ** HASHES

    def masks(self, keys: np.ndarray) -> np.ndarray:
        """Languages that may contain each n-gram, a row per word of the cells."""
        found = None
        for at in places(keys, self.bits):
            cells = self.cells[:, at]
            found = cells if found is None else found & cells
        return found

    def shares(self, keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Share of each text's n-grams in each language, false positives taken off."""
        total = np.bincount(owner, minlength=n).astype(float)
        found = self.masks(keys)
        out = np.zeros((n, len(self.languages)))
        for i, false_rate in enumerate(self.false_rate):
            hits = np.bincount(owner, (found[i // WORD] >> found.dtype.type(i % WORD)) & found.dtype.type(1), n)
            out[:, i] = np.maximum(hits - total * false_rate, 0) / np.maximum(total * (1 - false_rate), 1e-9)
        return out


PARTS = "word int, part int, cells binary"


def set_bits(bits: int, languages: int):
    """The parts of the filter that the (gram, language) rows of a task set."""
    kind = cell_type(languages)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((-(-languages // WORD), 1 << bits), kind)
        for batch in batches:
            language = numbers(batch, "language").astype(np.int64)
            mask = kind(1) << (language % WORD).astype(kind)
            for at in places(numbers(batch, "gram"), bits):
                np.bitwise_or.at(cells, (language // WORD, at), mask)
        parts = cells.reshape(len(cells), -1, min(PART, 1 << bits))
        for word, part in np.argwhere(parts.any(axis=2)).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([word], pa.int32()), pa.array([part], pa.int32()), pa.array([parts[word, part].tobytes()])], ["word", "part", "cells"]
            )

    return build


def _either(table: pa.Table) -> pa.Table:
    """All parts of one place in one; the bits do not depend on the type of a cell."""
    cells = None
    for x in table.column("cells").to_pylist():
        part = np.frombuffer(x, np.uint8)
        cells = part.copy() if cells is None else np.bitwise_or(cells, part, out=cells)
    return table.slice(0, 1).set_column(2, "cells", pa.array([cells.tobytes()]))


def learn_languages(training: DataFrame) -> LanguageFilter:
    """The filter from (doc_id, text, lang): counts of all texts, combined before the shuffle."""
    counts = training.where("lang is not null and text is not null").mapInArrow(_count, "lang string, gram long, n long")
    counts = stored(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram-counts")  # read twice
    sums = {r["lang"]: r for r in counts.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    languages = sorted(sums)
    kind = cell_type(len(languages))
    if not languages:
        return LanguageFilter([], np.zeros((1, 1), kind))
    entries = max(r["kinds"] for r in sums.values())
    bits = min(MAX_BITS, int(CELLS_PER_ENTRY * max(entries, 64) - 1).bit_length())
    table = [x for i, lang in enumerate(languages) for x in (F.lit(lang), F.struct(F.lit(i).alias("i"), F.lit(sums[lang]["n"]).alias("n")))]
    of = F.create_map(*table)[F.col("lang")]
    rates = counts.select("gram", of["i"].alias("language"), (F.col("n") / of["n"]).alias("rate"))
    # a row per language at most
    by_gram = rates.groupBy("gram").agg(F.collect_list(F.struct("language", "rate")).alias("of"), F.max("rate").alias("most"))
    kept = by_gram.select("gram", F.explode("of").alias("of"), "most").where(F.col("of.rate") >= MIN_SHARE * F.col("most"))
    parts = kept.select("gram", "of.language").mapInArrow(set_bits(bits, len(languages)), PARTS)
    cells = np.zeros((-(-len(languages) // WORD), 1 << bits), kind)
    width = min(PART, 1 << bits)
    for r in parts.groupBy("word", "part").applyInArrow(_either, PARTS).toLocalIterator():  # the cells of the filter, at most
        cells[r["word"], r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(r["cells"], kind)
    return LanguageFilter(languages, cells)


def predict_languages(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of every text; nothing is shuffled."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            n = batch.num_rows
            ascii_letter = np.concatenate([[0], np.cumsum(LETTER[lowered(data)] & (data < 0x80))])
            lettered = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
            for i in np.flatnonzero(~lettered):
                lettered[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "ignore"))
            names, scores = [UNDETERMINED] * n, np.zeros(n)
            if model.languages:
                shares = model.shares(*grams(data, offsets), n)
                best = shares.argmax(axis=1)
                scores = np.where(lettered, shares[np.arange(n), best] / np.maximum(shares.sum(axis=1), 1e-9), 0.0)
                names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return corpus(docs).mapInArrow(predict, "doc_id long, lang_pred string, score double")


def identify_languages(docs: DataFrame) -> DataFrame:
    """Learn from all folds but the held-out one, predict every text."""
    training = corpus(docs, "lang").where(fold("doc_id", FOLDS) != HELD_OUT)
    predicted = predict_languages(docs, learn_languages(training))
    return predicted.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
