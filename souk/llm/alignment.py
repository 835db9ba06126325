"""Alignment of the tokens of two tokenizers, by divide and conquer at shared cuts.

Both tokenizers cut the same bytes. A cut is a byte offset where a token of either ends. In an
interval of tokens a cut near the middle is located by bisecting the other side's ends for the
middle end and, without success, for its neighbours in a window that doubles; both halves are then
searched alike, and an interval without a cut is a leaf group. The intervals of many texts are
searched side by side, so each round is a few vectorised steps.

Two tokens that end together are linked; one of them is then a suffix of the other, so the pairs that
can ever occur follow from the two vocabularies alone (:func:`possible_pairs`). Counts of pairs are
arrays of that length, which bounds what the driver holds and sends, whatever the corpus.

Defined results: a text that is null or empty, or that a tokenizer does not give back byte by byte,
has no tokens and counts zero; equal rows are aligned alike and each counts; rows without an id stay;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.bpe import SPLIT, byte_letters
from souk.llm.common import corpus, slices, stored, strings

SPACE_MARK = "▁"
COMMA, BAR, SEMICOLON = b",|;"
MEMO_WORDS, MEMO_TOKENS = 400_000, 4_000_000  # words kept per worker; the memory bound, not a cut
TOGETHER = 20_000
ZERO = np.zeros(0, np.int64)


class ByteSide:
    """A byte-level vocabulary: text to ids, ids to bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        special = {t["content"] for t in spec["added_tokens"]}
        words = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        ranks = {bytes(letters[c] for c in token): i for token, i in words.items()}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        if any(words[x] >= words[y] for x, y in zip(merged, merged[1:])):
            raise ValueError("ids must follow the order of merges")
        self.coder = tiktoken.Encoding("own", pat_str=SPLIT.pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.coder.encode_ordinary(" " + text), np.int64) for text in texts]


class PieceSide:
    """A sentence-piece vocabulary with byte fallback; it puts the space before a text itself."""

    def __init__(self, path: str):
        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        spelled = [self.coder.id_to_piece(i) for i in range(self.coder.get_piece_size())]
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if self.coder.is_byte(i)
            else b"" if self.coder.is_control(i) or self.coder.is_unknown(i)
            else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(spelled)
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.coder.encode(texts, num_threads=1)]


def possible_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """All pairs of ids of which one's bytes end with the other's, as sorted ``a << 32 | b``."""
    found: set[int] = set()
    for one, other, shift_one, shift_other in ((a, b, 32, 0), (b, a, 0, 32)):
        ids: dict[bytes, list[int]] = {}
        for i, token in enumerate(other):
            if token:
                ids.setdefault(token, []).append(i)
        for i, token in enumerate(one):
            for at in range(len(token)):
                found.update(i << shift_one | j << shift_other for j in ids.get(token[at:], ()))
    return np.array(sorted(found), np.int64)


def _ragged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of many ranges, and the range each stands in."""
    sizes = stops - starts
    owner = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[owner], owner


def shared_cuts(
    ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of either side end at a shared cut.

    ``ends_*``: increasing byte offsets where the tokens of all texts, one after the other, end;
    ``last_*``: the number of each text's last token. Texts end together.
    """
    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    cut_a[last_a] = cut_b[last_b] = True
    # open intervals: the ends strictly inside, as ranges of token numbers on both sides
    low = np.concatenate([[0], last_a[:-1] + 1]) if len(last_a) else np.zeros(0, np.int64)
    low_b = np.concatenate([[0], last_b[:-1] + 1]) if len(last_b) else np.zeros(0, np.int64)
    high, high_b = last_a, last_b
    width = np.ones(len(low), np.int64)  # the window reaches to less than this far from the middle
    while True:
        some = (low < high) & (low_b < high_b)
        if not some.all():
            low, high, low_b, high_b, width = (x[some] for x in (low, high, low_b, high_b, width))
        if not len(low):
            return cut_a, cut_b
        middle = (low + high) // 2
        first, stop = np.maximum(low, middle - width + 1), np.minimum(high, middle + width)
        probe, owner = _ragged(first, stop)
        at = np.searchsorted(ends_b, ends_a[probe])
        hits = np.flatnonzero(ends_b[at] == ends_a[probe])
        # the hit nearest to the middle of its interval
        hits = hits[np.lexsort((np.abs(probe[hits] - middle[owner[hits]]), owner[hits]))]
        hits = hits[np.diff(owner[hits], prepend=-1) != 0]
        split, cut, other = owner[hits], probe[hits], at[hits]
        cut_a[cut] = True
        cut_b[other] = True
        rest = np.ones(len(low), bool)
        rest[split] = False
        rest &= (first > low) | (stop < high)  # a window over the whole interval: a leaf
        parts = (
            (low[split], cut + 1, low[rest]),
            (cut, high[split], high[rest]),
            (low_b[split], other + 1, low_b[rest]),
            (other, high_b[split], high_b[rest]),
            (np.ones(2 * len(split), np.int64), 2 * width[rest]),
        )
        order = np.argsort(np.concatenate(parts[0]), kind="stable")  # in text order, bisecting is quick
        low, high, low_b, high_b, width = (np.concatenate(x)[order] for x in parts)


class Words:
    """Tokens of words seen before, for both sides.

    Neither tokenizer joins a space to what stands before it, so a text is encoded word by word, each
    with its space. That does not hold where white space follows a space, and a word may be one that
    a tokenizer does not give back: texts with such words are encoded whole.
    """

    def __init__(self, sides: tuple[ByteSide, PieceSide]):
        self.sides = sides
        inside = [p for p in map(bytes, sides[1].bytes_of) if b" " in p.lstrip(b" ")]
        self.apart = not inside  # no piece holds a space after another character
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.plain = np.zeros(0, bool)
        self.flat = [ZERO for _ in self.sides]
        self.ends = [np.zeros(1, np.int64) for _ in self.sides]

    def learn(self, words: list[str]) -> None:
        """Encode new words, many in one go where both sides give the joined words back."""
        plain = [w for w in words if self.apart and w and not w[0].isspace()]
        taken = set(plain)
        for at in range(0, len(plain), TOGETHER):
            self._learn_joined(plain[at : at + TOGETHER])
        self._learn_apart([w for w in words if w not in taken], False)

    def _learn_joined(self, words: list[str]) -> None:
        text = " ".join(words)
        whole = (" " + text).encode()
        ends = np.cumsum([len(w) for w in map(str.encode, words)]) + np.arange(1, len(words) + 1)
        parts = []
        for side in self.sides:
            ids = side.encode([text])[0]
            spelled = list(map(side.bytes_of.__getitem__, ids.tolist()))
            stops = np.cumsum(np.fromiter(map(len, spelled), np.int64, len(spelled)))
            at = np.searchsorted(stops, ends)
            if b"".join(spelled) != whole or (stops[at] != ends).any():
                return self._learn_apart(words, True)
            parts.append((ids, at + 1))
        self._add(words, np.ones(len(words), bool), parts)

    def _learn_apart(self, words: list[str], plain: bool) -> None:
        coded = [side.encode(words) for side in self.sides]
        same = self.given_back(words, coded) if plain else [False] * len(words)
        sizes = [np.array([len(x) for x in tokens], np.int64) for tokens in coded]
        self._add(words, np.array(same, bool), [(np.concatenate([ZERO, *x]), np.cumsum(n)) for x, n in zip(coded, sizes)])

    def _add(self, words: list[str], plain: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.plain = np.concatenate([self.plain, plain])
        for k, (ids, ends) in enumerate(parts):
            self.ends[k] = np.concatenate([self.ends[k], self.ends[k][-1] + ends])
            self.flat[k] = np.concatenate([self.flat[k], ids])

    def given_back(self, texts: list[str], coded: list[list[np.ndarray]]) -> list[bool]:
        """Which texts both sides give back, byte by byte."""
        return [
            all(b"".join(map(side.bytes_of.__getitem__, ids.tolist())) == whole for side, ids in zip(self.sides, found))
            for whole, *found in zip([(" " + t).encode() for t in texts], *coded)
        ]

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each side the ids of all texts and their number per text."""
        if len(self.known) > MEMO_WORDS or max(map(len, self.flat)) > MEMO_TOKENS:
            self.clear()
        split = [text.split(" ") if text else [] for text in texts]
        words = [w for parts in split for w in parts]
        self.learn(sorted(set(words) - self.known.keys()))
        number = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        n_words = np.array([len(parts) for parts in split], np.int64)
        owner = np.repeat(np.arange(len(texts)), n_words)
        whole = np.unique(owner[~self.plain[number]])  # these are encoded as a whole
        number = number[~np.isin(owner, whole)]
        n_words[whole] = 0
        apart = [texts[k] for k in whole.tolist()]
        coded = [side.encode(apart) for side in self.sides]
        same = self.given_back(apart, coded)
        out = []
        for flat, ends, found in zip(self.flat, self.ends, coded):
            at, word = _ragged(ends[number], ends[number + 1])
            last = np.concatenate([[0], np.cumsum(ends[number + 1] - ends[number])])
            sizes = np.diff(last[np.concatenate([[0], np.cumsum(n_words)])])
            ids = flat[at]
            if len(whole):
                kept = [x if ok else x[:0] for x, ok in zip(found, same)]
                before = np.cumsum(sizes)[whole]
                ids = np.insert(ids, np.repeat(before, [len(x) for x in kept]), np.concatenate(kept))
                sizes[whole] = [len(x) for x in kept]
            out.append((ids, sizes))
        return out


@dataclass
class Aligned:
    """Tokens and cuts of the texts of one slice; texts without tokens have empty ranges."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    n_a: np.ndarray  # tokens per text
    n_b: np.ndarray

    @property
    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The text, A id and B id of each link, in order."""
        text = np.repeat(np.arange(len(self.n_a)), self.n_a)
        return text[self.cut_a], self.ids_a[self.cut_a], self.ids_b[self.cut_b]


class Aligner:
    """Two vocabularies and the pairs of ids that can be linked."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteSide(byte_path), PieceSide(piece_path)
        self.words = Words((self.a, self.b))
        self.pairs = possible_pairs(self.a.bytes_of, self.b.bytes_of)
        self.length_a, self.length_b = (np.array([len(x) for x in side.bytes_of]) for side in (self.a, self.b))
        most = max(len(self.a.bytes_of), len(self.b.bytes_of))
        width = len(str(most))
        digits = np.zeros((most, width + 1), np.uint8)  # the last column takes the separator
        for i in range(most):
            spelled = str(i).encode()
            digits[i, width - len(spelled) : width] = list(spelled)
        self.digits = digits

    def align(self, texts: list[str]) -> Aligned:
        tokens = self.words.tokens(texts)
        (ids_a, n_a), (ids_b, n_b) = tokens
        full = n_a > 0
        cut_a, cut_b = shared_cuts(
            np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b]),
            np.cumsum(n_a)[full] - 1, np.cumsum(n_b)[full] - 1,
        )
        return Aligned(ids_a, ids_b, cut_a, cut_b, n_a, n_b)

    def spelled(self, x: Aligned) -> list[bytes]:
        """The groups of each text, as ``a1,a2|b1;a3|b2,b3``."""
        group_a, group_b = np.cumsum(x.cut_a) - x.cut_a, np.cumsum(x.cut_b) - x.cut_b
        last_a, first_b = np.flatnonzero(x.cut_a), np.concatenate([[0], np.flatnonzero(x.cut_b) + 1])
        at_a = np.arange(len(group_a)) + first_b[group_a]
        at_b = np.arange(len(group_b)) + last_a[group_b] + 1
        out = np.zeros((len(group_a) + len(group_b), self.digits.shape[1]), np.uint8)
        out[at_a], out[at_b] = self.digits[x.ids_a], self.digits[x.ids_b]
        out[at_a, -1] = np.where(x.cut_a, BAR, COMMA)
        out[at_b, -1] = np.where(x.cut_b, SEMICOLON, COMMA)
        used = out != 0
        ends = np.concatenate([[0], np.cumsum(used.sum(1))])[np.concatenate([[0], np.cumsum(x.n_a + x.n_b)])]
        text = out[used].tobytes()
        return [text[i : j - 1] if j > i else b"" for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The numbers of pairs in :attr:`pairs`."""
        return np.searchsorted(self.pairs, a << 32 | b)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One aligner per pair of files and worker process."""
    key = (byte_path, piece_path)
    if key not in _aligners:
        _aligners[key] = Aligner(byte_path, piece_path)
    return _aligners[key]


LISTED = pa.list_(pa.int32())
LINKED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def linked_documents(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Per document: counts, digest of its groups, its distinct linked pairs and how often each is linked."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = aligner(byte_path, piece_path)
        many = len(pair.pairs)
        for part, _, _ in slices(batches):
            x = pair.align(strings(part))
            text, a, b = x.links
            n_links = np.bincount(text, minlength=part.num_rows)
            keys, times = np.unique(text * many + pair.number(a, b), return_counts=True)
            sizes = np.bincount(keys // many, minlength=part.num_rows)
            digests = [hashlib.sha256(s).hexdigest() if s else "" for s in pair.spelled(x)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *map(pa.array, (x.n_a, x.n_b, n_links, n_links)), pa.array(digests, pa.string()),
                 _lists(keys % many, sizes), _lists(times, sizes)],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )

    return corpus(docs).mapInArrow(work, LINKED)


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)


def pair_counts(linked: DataFrame, many: int) -> DataFrame:
    """How many links of the corpus hold each pair; a task sends each pair at most once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(many, np.int64)
        for batch in batches:
            counts += np.bincount(_flat(batch, "pairs"), _flat(batch, "times"), many).astype(np.int64)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], ["pair", "n"])

    partial = linked.select("pairs", "times").mapInArrow(work, "pair int, n long")
    return partial.groupBy("pair").agg(F.sum("n").alias("n"))


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align_documents(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Counts of each document's groups and links, weighed by the links of the whole corpus.

    The texts are read once; their pairs are stored and read again for the counts.
    """
    spark = docs.sparkSession
    pairs = aligner(byte_path, piece_path).pairs
    linked = stored(linked_documents(docs, byte_path, piece_path), "aligned")
    counts = np.zeros(len(pairs), np.int64)
    found = pair_counts(linked, len(pairs)).toArrow()  # at most one row per possible pair
    counts[found["pair"].to_numpy()] = found["n"].to_numpy()
    highest = np.zeros(int((pairs & 0xFFFFFFFF).max()) + 1, np.int64)
    np.maximum.at(highest, pairs & 0xFFFFFFFF, counts)
    shared = spark.sparkContext.broadcast((counts, counts == highest[pairs & 0xFFFFFFFF]))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = shared.value
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("pairs"))
            sizes = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            pair, times = _flat(batch, "pairs"), _flat(batch, "times").astype(np.int64)
            total, n_best = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, owner, times * count[pair])
            np.add.at(n_best, owner, times * best[pair])
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_best), pa.array(total), batch.column(batch.schema.get_field_index("groups_sha256"))],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    return linked.mapInArrow(weigh, RESULT)


def groups_of(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """The groups themselves: one row per group, with the ids of both sides."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = aligner(byte_path, piece_path)
        for part, _, _ in slices(batches):
            x = pair.align(strings(part))
            text = np.repeat(np.arange(part.num_rows), x.n_a)[x.cut_a]
            first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=part.num_rows))])
            sides = [np.diff(np.flatnonzero(cut), prepend=-1) for cut in (x.cut_a, x.cut_b)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(text)), pa.array(np.arange(len(text)) - first[text]),
                 _lists(x.ids_a, sides[0]), _lists(x.ids_b, sides[1])],
                ["doc_id", "group_no", "ids_a", "ids_b"],
            )

    return corpus(docs).mapInArrow(work, "doc_id long, group_no long, ids_a array<int>, ids_b array<int>")
