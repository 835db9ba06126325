"""Packing tokenized documents into sequences by cutting-stock column generation.

Documents longer than a sequence give full pieces and one rest. Rests of ``FINE`` tokens or more are
counted in steps of ``STEP`` tokens, rounded up; shorter ones are counted by their exact length, and as many
of one length as fill whole steps (``8 * FINE`` tokens at most) are one unit, so rounding costs under
``STEP / FINE`` of a piece however short the documents are. The units' steps
are a cutting-stock problem over at most ``size / STEP`` demands: a linear program over patterns, whose columns a knapsack dynamic program prices. Rounded patterns and the few
patterns that pack what rounding left are a plan as small as the histogram. Pieces are ranked
within their length class without a global sort, and the plan turns a rank into a sequence.

Defined results: null and empty texts have one token, the end mark; documents of equal length are
told apart by id and place; repeated rows are packed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.bpe import byte_letters
from souk.llm.common import corpus, shards, stored, strings

SIZE = 4096
STEP = 8
FINE = 64
END_ID = 2
MEMO_ENTRIES = 500_000
MARKS = ".,;:!?#*$%&|<>"  # not the apostrophe, which can begin a match of its own
GAP = 1e-4

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, slot long"

class ChunkIds(dict):
    """Ids of the text between spaces as little-endian 32-bit integers, encoded once for all copies.

    This vocabulary drops white space, and its matches never contain any, so each chunk can be encoded
    on its own. Most chunks are one word of Latin letters, perhaps with marks after it: such a word
    is one match in lower case, and goes to the library's model directly. All other chunks take the
    library's whole way.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        known = self.words.get(word)
        if known is None:
            spelled = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
            ids = [token.id for token in self.model.tokenize(spelled)]
            known = self.words[word] = pack("<%dI" % len(ids), *ids)
        return known

    def __missing__(self, chunk: str) -> bytes:
        word = chunk.rstrip(MARKS)
        tail = chunk[len(word) :]  # marks in a row are one match
        # below U+0250 letters are composed already and, but for one, have a single lower case
        if word.isalpha() and (word.isascii() or max(word) < "\u0250" and "\u0130" not in word):
            found = self._word(word.lower()) + (self._word(tail) if tail else b"")
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            found = pack("<%dI" % len(ids), *ids)
        self[chunk] = found
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        if len(self.words) > MEMO_ENTRIES:
            self.words.clear()
        return [b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))) for text in texts]


_encoders: dict[str, ChunkIds] = {}


def encode_chunks(path: str, texts: list[str]) -> list[bytes]:
    """Ids of texts, by one encoder per file and worker process."""
    if path not in _encoders:
        _encoders[path] = ChunkIds(path)
    return _encoders[path].encode(texts)


def cut_pieces(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Full pieces and the rest of each document, with the checksum of their ids."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                out: list[list[int]] = [[], [], [], [], []]
                for doc_id, ids in zip(batch.column(0).to_pylist(), encode_chunks(path, strings(batch))):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, size):
                        part = ids[4 * start : 4 * (start + size)]
                        for column, value in zip(out, (doc_id, start, len(part) // 4, zlib.crc32(part), total)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in out], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                )

    return corpus(docs).mapInArrow(cut, PIECES)


def price(values: np.ndarray, weights: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The knapsack with copies: best total value within ``room``, and how often each item is taken."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1)
    order = np.argsort(weights, kind="stable")
    sorted_weights, sorted_values = weights[order], values[order]
    fitting = np.searchsorted(sorted_weights, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        if fitting[c]:
            gains = sorted_values[: fitting[c]] + best[c - sorted_weights[: fitting[c]]]
            k = int(gains.argmax())
            if gains[k] > best[c] + 1e-12:
                best[c], choice[c] = gains[k], order[k]
    taken, c = np.zeros(len(weights), int), room
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            taken[choice[c]] += 1
            c -= weights[choice[c]]
    return float(best[room]), taken


def solve_patterns(weights: np.ndarray, demand: np.ndarray, room: int, rounds: int = 20_000) -> list[tuple[np.ndarray, float]]:
    """The linear program by column generation: patterns and how often each is used.

    Revised simplex on one row per length. It stops when no pattern prices above ``1 + GAP``, which
    bounds the distance to the optimum by that share (``rounds`` only guards against cycling: any
    basis on the way is a valid, less tight plan).
    """
    n = len(weights)
    columns = [np.where(np.arange(n) == i, room // weights[i], 0) for i in range(n)]
    inverse = np.diag(1.0 / np.array([columns[i][i] for i in range(n)]))
    used = inverse @ demand
    for _ in range(rounds):
        value, pattern = price(np.ones(n) @ inverse, weights, room)
        if value <= 1 + GAP:
            break
        step = inverse @ pattern
        rising = step > 1e-9
        ratios = np.full(n, np.inf)
        ratios[rising] = used[rising] / step[rising]
        out = int(ratios.argmin())
        amount = ratios[out]
        used = used - amount * step
        used[out] = amount
        row = inverse[out] / step[out]
        inverse = inverse - np.outer(step, row)
        inverse[out] = row
        columns[out] = pattern
    return [(columns[i], float(used[i])) for i in range(n) if used[i] > 1e-9]


def fullest(weights: np.ndarray, left: np.ndarray, room: int) -> np.ndarray:
    """What fills one sequence best from the pieces left, starting with the longest of them."""
    taken = np.zeros(len(weights), int)
    first = int(np.flatnonzero(left)[np.argmax(weights[np.flatnonzero(left)])])
    taken[first], room = 1, room - int(weights[first])
    reached: dict[int, tuple[int, int]] = {0: (-1, 0)}  # filled -> (item of the last step, filled before)
    for i in sorted(np.flatnonzero(left - taken), key=lambda i: -weights[i]):
        spare, weight = int(left[i] - taken[i]), int(weights[i])
        for filled in list(reached):
            at = filled
            for _ in range(min(spare, (room - filled) // weight)):
                if at + weight in reached:
                    break
                reached[at + weight] = (i, at)
                at += weight
        if room in reached:
            break
    at = max(reached)
    while at:
        i, at = reached[at]
        taken[i] += 1
    return taken


def packing_plan(lengths: dict[int, int], size: int = SIZE, step: int = STEP) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, rank after the last, first sequence, pieces of the class in a sequence).

    The classes are lengths in steps, rounded up; ranks of a class count from 0.
    """
    classes = np.array(sorted(lengths), int)
    left = np.array([lengths[c] for c in classes], np.int64)
    room = size // step
    chosen: list[tuple[np.ndarray, int]] = []

    def take(pattern: np.ndarray, times: int) -> None:
        nonlocal left
        if times > 0:
            chosen.append((pattern, times))
            left = left - times * pattern

    if len(classes):
        for pattern, times in sorted(solve_patterns(classes, left.astype(float), room), key=lambda x: -x[1]):
            used = pattern > 0
            take(pattern, min(int(times + 1e-6), int((left[used] // pattern[used]).min())))
    while left.any():
        pattern = fullest(classes, left, room)
        used = pattern > 0
        take(pattern, int((left[used] // pattern[used]).min()))
    plan, ranks, sequence = [], {int(c): 0 for c in classes}, 0
    for pattern, times in chosen:
        for i in np.flatnonzero(pattern):
            c, per = int(classes[i]), int(pattern[i])
            plan.append((c, ranks[c], ranks[c] + per * times, sequence, per))
            ranks[c] += per * times
        sequence += times
    return plan


def piece_class(length: Column, step: int = STEP) -> Column:
    """The exact length below ``FINE`` tokens, whole steps above."""
    return F.when(length < FINE, length).otherwise(F.ceil(length / step) * step).cast("int")


def unit_plan(lengths: dict[int, int], size: int = SIZE, step: int = STEP) -> list[tuple[int, int, int, int, int, int]]:
    """(class, first rank, pieces of a unit, units before it in its pattern, units in a sequence, first sequence).

    The classes are those of :func:`piece_class`; a row holds up to the next one of its class.
    """
    units: dict[int, list[tuple[int, int, int, int]]] = {}  # steps -> (class, pieces of a unit, first rank, units)
    for length, n in sorted(lengths.items()):
        each = max(1, min(step // math.gcd(length, step), 8 * FINE // length, size // length)) if length < FINE else 1
        for pieces, first, count in ((each, 0, n // each), (1, n - n % each, n % each)):
            if count:
                units.setdefault(-(-pieces * length // step), []).append((length, pieces, first, count))
    rows = []
    for steps, first, after, sequence, per in packing_plan({k: sum(u[3] for u in found) for k, found in units.items()}, size, step):
        at = 0
        for length, pieces, rank, count in units[steps]:
            begin = max(first, at)
            if begin < min(after, at + count):
                rows.append((length, rank + (begin - at) * pieces, pieces, begin - first, per, sequence))
            at += count
    return sorted(rows)


def pack_documents(docs: DataFrame, path: str, size: int = SIZE, step: int = STEP, end_id: int = END_ID) -> DataFrame:
    """Every piece with its sequence and offset."""
    spark = docs.sparkSession
    group = [F.col("class"), F.col("bucket")]
    pieces = stored(
        cut_pieces(docs, path, size, end_id)
        .withColumn("class", piece_class(F.col("length"), step))
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(2 * shards(spark))).cast("int")),
        "pieces",
    )
    counts = pieces.groupBy(*group).count()
    # ranks within a class: a count per bucket, then places within the bucket
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = stored(counts.withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0))), "ranks")
    # at most FINE + size / step rows, whatever the size of the corpus
    lengths = {r["class"]: r["n"] for r in firsts.groupBy("class").agg(F.sum("count").alias("n")).collect()}
    table = np.array(unit_plan(lengths, size, step), np.int64).reshape(-1, 6)
    keys = (table[:, 0] << 44) + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = {name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}
            found = np.searchsorted(keys, (of["class"].astype(np.int64) << 44) + of["rank"], side="right") - 1
            unit = (of["rank"] - table[found, 1]) // table[found, 2] + table[found, 3]
            copy, slot = np.divmod(unit, table[found, 4])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(table[found, 5] + copy), pa.array((of["class"] << 16) + slot)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"],
            )

    place_in_bucket = F.row_number().over(Window.partitionBy(*group).orderBy("doc_id", "start")).cast("long")
    ranked = (
        pieces.withColumn("place", place_in_bucket - 1)
        .join(firsts.select(*group, "first"), ["class", "bucket"])
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("class").cast("long"), (F.col("first") + F.col("place")).alias("rank"))
    )
    packed = ranked.mapInArrow(place, PACKED)
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("slot"), "doc_id", "start").rowsBetween(Window.unboundedPreceding, -1)
    return packed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("long")).drop("slot")
