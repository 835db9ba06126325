"""Byte-level BPE by prefix-sharing trie traversal.

The encoding of a word is fixed by one state per prefix: the last token of the prefix's encoding.
A token can end a prefix exactly if it is compatible with the last token of what stands before it,
and exactly one token is. Distinct words, in byte order, are visited as a depth-first walk of their
trie: a word starts at the state of the prefix that it shares with the word before, so
that shared prefixes are encoded once.

Defined results: null and empty texts have no tokens; the text of an added token is that token, as
in the tokenizers library; equal rows are encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from souk.llm.common import corpus, strings

# Fixed value: how the byte-level vocabularies split a text before the merges.
SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
MEMO_ENTRIES = 1_200_000
ODD = b"?"  # stands for a chunk that cannot be split on its own; no encoding has its length
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for the 256 bytes in a vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieEncoder:
    """Encodes words of one vocabulary file; states of words seen are kept, up to a bound."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.ids = {as_bytes(token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.spelled = [pack("<I", i) for i in range(max(self.ids.values()) + 1)]
        self._link(sorted(self.ids.items()))
        self.bytes_of = {i: token for token, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> its two parts and the rank of their merge
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = (as_bytes(x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            pair, whole = (self.ids[left], self.ids[right]), self.ids[left + right]
            self.rank[pair] = rank
            self.parts.setdefault(whole, (*pair, rank))
        self.edges: tuple[dict, dict] = ({}, {})
        self.fits: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.first_words: dict[str, bytes] = {}

    def _link(self, tokens: list[tuple[bytes, int]]) -> None:
        """The automaton of all tokens: a state is the longest start of a token that ends where we are."""
        self.step: list[dict[int, int]] = [{}]
        self.ending: list[tuple] = [()]  # (token, size) of all tokens that end here, longest first
        self.shorter = [0]  # the state of the next shorter start of a token
        for token, i in tokens:
            at = 0
            for byte in token:
                if byte not in self.step[at]:
                    self.step[at][byte] = len(self.step)
                    self.step.append({})
                    self.ending.append(())
                    self.shorter.append(0)
                at = self.step[at][byte]
            self.ending[at] = ((i, len(token)),)
        wave = [(0, byte, to) for byte, to in self.step[0].items()]
        while wave:
            for parent, byte, at in wave:
                if parent:
                    back = self.shorter[parent]
                    while back and byte not in self.step[back]:
                        back = self.shorter[back]
                    self.shorter[at] = self.step[back].get(byte, 0)
                self.ending[at] += self.ending[self.shorter[at]]
            wave = [(at, byte, to) for _, _, at in wave for byte, to in self.step[at].items()]

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens on one edge of a token's merge tree, each with the rank that consumes it."""
        known = self.edges[side].get(token)
        if known is None:
            known, at, consumed = [], token, NEVER
            while True:
                known.append((at, consumed))
                if at not in self.parts:
                    break
                consumed, at = self.parts[at][2], self.parts[at][side]
            self.edges[side][token] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge happens across the border of two neighbouring tokens.

        A merge of two edge tokens happens if its turn comes before either is consumed inside its
        own token; at equal ranks the one further left goes first.
        """
        key = left << 32 | right
        fits = self.fits.get(key)
        if fits is None:
            rank = self.rank
            fits = not any(
                (r := rank.get((a, b), NEVER)) < gone_a and r <= gone_b and r < NEVER
                for a, gone_a in self._edge(left, 1)
                for b, gone_b in self._edge(right, 0)
            )
            if len(self.fits) > 2 * MEMO_ENTRIES:
                self.fits.clear()
            self.fits[key] = fits
        return fits

    def encode_sorted(self, words: list[bytes]) -> Iterator[bytes]:
        """Token ids (little-endian, 32 bits) of distinct words in byte order."""
        compatible, fits, step, ending, shorter = self.compatible, self.fits, self.step, self.ending, self.shorter
        spelled = self.spelled
        before = b""
        last = [-1]  # last token of each prefix of the current path in the trie
        size = [0]
        states = [0]  # state of the tokens' automaton behind each prefix
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], size[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            for end in range(shared + 1, len(word) + 1):
                byte = word[end - 1]
                while (to := step[state].get(byte)) is None and state:
                    state = shorter[state]
                state = to or 0
                states.append(state)
                for token, length in ending[state]:
                    good = length == end or fits.get(last[end - length] << 32 | token)
                    if good or good is None and compatible(last[end - length], token):
                        last.append(token)
                        size.append(length)
                        break
            out, at = [], len(word)
            while at:
                out.append(spelled[last[at]])
                at -= size[at]
            yield b"".join(out[::-1])
            before = word

    def _learn(self, chunks: Iterable[str], memo: dict[str, bytes], space: str) -> None:
        """Encodings of chunks of text, by way of the distinct words in them."""
        split = {}
        for chunk in chunks:
            if chunk.isalpha():  # letters only: one word, no need to match
                split[chunk] = (space + chunk,)
            elif chunk[:-1].isalpha() and chunk[-1:] in ".,":
                split[chunk] = (space + chunk[:-1], chunk[-1])
            elif space and (not chunk or chunk[0].isspace() or chunk[-1].isspace()):
                memo[chunk] = ODD  # white space in a row is split with its neighbours
            else:
                split[chunk] = SPLIT.findall(space + chunk)
        words = sorted({w.encode(): w for parts in split.values() for w in parts}.items())
        coded = dict(zip([w for _, w in words], self.encode_sorted([b for b, _ in words])))
        for chunk, parts in split.items():
            memo[chunk] = coded[parts[0]] if len(parts) == 1 else b"".join(map(coded.__getitem__, parts))

    def _known(self, chunks: list[str], memo: dict[str, bytes], space: str) -> list[bytes]:
        """The encodings of the chunks, learned where they are new."""
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        found = list(map(memo.get, chunks))
        if None in found:
            self._learn({c for c, known in zip(chunks, found) if known is None}, memo, space)
            found = list(map(memo.__getitem__, chunks))
        return found

    def _encode_plain(self, text: str) -> bytes:
        if not text:
            return b""
        chunks = text.split(" ")
        found = self._known(chunks, self.words, " ")
        if ODD in found:
            return b"".join(self._known(SPLIT.findall(text), self.first_words, ""))
        found[0] = self._known(chunks[:1], self.first_words, "")[0]
        return b"".join(found)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        self._prepare(texts)
        return [self.encode(text) for text in texts]

    def _prepare(self, texts: list[str]) -> None:
        """Insert the words of many texts at once, so that they share their prefixes."""
        chunks: set[str] = set()
        for text in texts:
            chunks.update(text.split(" "))
        missing = [c for c in chunks if c not in self.words]
        if len(self.words) + len(missing) > MEMO_ENTRIES:
            self.words.clear()
            missing = list(chunks)
        if len(missing) < MEMO_ENTRIES:
            self._learn(missing, self.words, " ")

    def encode(self, text: str) -> bytes:
        marks = [m for m in self.special if m in text]
        if not marks:
            return self._encode_plain(text)
        pattern = "(" + "|".join(map(regex.escape, sorted(marks, key=len, reverse=True))) + ")"
        return b"".join(
            np.array([self.special[part]], "<u4").tobytes() if part in self.special else self._encode_plain(part)
            for part in regex.split(pattern, text)
        )

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_encoders: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    """One encoder per file and worker process."""
    if path not in _encoders:
        _encoders[path] = TrieEncoder(path)
    return _encoders[path]


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
TOGETHER = 2000


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Token counts and digests of ids and decoded text; one pass, nothing is shuffled."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(at, TOGETHER)
                ids = coder.encode_all(strings(batch))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                        pa.array([hashlib.sha256(coder.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return corpus(docs).mapInArrow(digests, SCHEMA)


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """The ids themselves: ``doc_id``, ``ids array<int>``."""

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in coder.encode_all(strings(batch))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return corpus(docs).mapInArrow(arrays, "doc_id long, ids array<int>")
