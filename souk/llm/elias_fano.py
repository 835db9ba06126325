"""Elias-Fano levels of an n-gram trie: monotone integers in low bits and a unary upper part.

A level keeps the successors of all contexts in one monotone sequence: each successor is stored
relative to its context, as ``context * width + successor``, and the pointers to the contexts' ranges
are a monotone sequence of their own. Levels are written to a file and memory-mapped, and stay packed:
an opened level adds two numbers per 64 bits of its upper part, the ones and the zeros before them.
A successor search looks only at the few values that share the upper part of the value sought.
"""

from __future__ import annotations

import numpy as np

HEAD = 4  # 64-bit words before a sequence: count, low bits, bytes of the low and of the upper part
VALUE_BITS = 12
CHUNK = 1 << 16  # values packed at a time, a multiple of 8
U64 = np.uint64


def pack(values: np.ndarray, width: int) -> bytes:
    """The ``width`` lowest bits of each value, and at least 8 bytes more."""
    places, parts = np.arange(width, dtype=U64), []
    for at in range(0, len(values), CHUNK):
        bits = (values[at : at + CHUNK, None].astype(U64) >> places & U64(1)).astype(np.uint8)
        parts.append(np.packbits(bits.ravel(), bitorder="little").tobytes())
    data = b"".join(parts)
    return data + bytes(8 - len(data) % 8 + 8)


def unpack(data: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """The packed values at some places."""
    if not width:
        return np.zeros(len(at), np.int64)
    bit = at * width
    word = np.zeros(len(at), U64)
    for k in range((width + 14) // 8):
        word |= data[(bit >> 3) + k].astype(U64) << U64(8 * k)
    word >>= (bit & 7).astype(U64)
    return (word & U64((1 << width) - 1)).astype(np.int64)


def encode(values: np.ndarray) -> bytes:
    """A non-decreasing sequence of non-negative integers."""
    values = values.astype(U64)
    n = len(values)
    top = int(values[-1]) + 1 if n else 1
    low = max(0, (top // max(n, 1)).bit_length() - 1)
    lows = pack(values, low)
    upper = np.zeros(n + (top >> low) + 1, np.uint8)
    upper[(values >> U64(low)).astype(np.int64) + np.arange(n)] = 1
    uppers = np.packbits(upper, bitorder="little").tobytes()
    pad = -len(uppers) % 8
    return np.array([n, low, len(lows), len(uppers) + pad], "<u8").tobytes() + lows + uppers + bytes(pad)


def place_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the one of each word that has ``rank`` ones below it."""
    place = np.zeros(len(words), np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        below = words & U64((1 << half) - 1)
        ones = np.bitwise_count(below).astype(np.int64)
        above = rank >= ones
        rank = np.where(above, rank - ones, rank)
        words = np.where(above, words >> U64(half), below)
        place += half * above
    return place


class Sequence:
    """A mapped sequence; ``size`` is the number of bytes it takes."""

    def __init__(self, mapped: np.ndarray):
        self.n, self.low, n_low, n_upper = (int(x) for x in mapped[: 8 * HEAD].view("<u8"))
        self.size = 8 * HEAD + n_low + n_upper
        self.lows = mapped[8 * HEAD : 8 * HEAD + n_low]
        self.words = mapped[8 * HEAD + n_low : self.size].view("<u8")
        kind = np.uint32 if n_upper < 1 << 29 else np.uint64
        self.ones = np.zeros(len(self.words), kind)  # before each word
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.ones[1:])
        self.zeros = np.arange(len(self.words), dtype=kind) * kind(64) - self.ones

    def at(self, places: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, places.astype(self.ones.dtype), side="right") - 1
        one = 64 * word + place_in_word(self.words[word], places - self.ones[word].astype(np.int64))
        return (one - places << self.low) + unpack(self.lows, self.low, places)

    def _begin(self, upper: np.ndarray) -> np.ndarray:
        """Number of values with a smaller upper part, which is the number of ones before the zero that ends them."""
        begin = np.where(upper > 0, self.n, 0)
        inside = np.flatnonzero((upper > 0) & (upper <= 64 * len(self.words) - self.n))
        rank = upper[inside] - 1
        word = np.searchsorted(self.zeros, rank.astype(self.zeros.dtype), side="right") - 1
        zero = 64 * word + place_in_word(~self.words[word], rank - self.zeros[word].astype(np.int64))
        begin[inside] = zero - rank
        return begin

    def successor(self, sought: np.ndarray) -> np.ndarray:
        """Place of the first value not below each sought one."""
        upper = sought >> self.low
        first, last = self._begin(upper), self._begin(upper + 1)
        below = sought & ((1 << self.low) - 1)
        while True:  # halve the ranges that share the upper part
            open_ = np.flatnonzero(first < last)
            if not len(open_):
                return first
            middle = (first[open_] + last[open_]) >> 1
            smaller = unpack(self.lows, self.low, middle) < below[open_]
            first[open_[smaller]] = middle[smaller] + 1
            last[open_[~smaller]] = middle[~smaller]


def quantised(values: np.ndarray, low: float, high: float) -> np.ndarray:
    """The nearest of ``2**VALUE_BITS`` even steps from ``low`` to ``high``, as its number."""
    last = (1 << VALUE_BITS) - 1
    return np.clip(np.rint((values - low) * (last / max(high - low, 1e-9))), 0, last).astype(np.int64)


def restored(steps: np.ndarray, low: float, high: float) -> np.ndarray:
    return low + steps * (max(high - low, 1e-9) / ((1 << VALUE_BITS) - 1))


def trie(
    context: np.ndarray, successor: np.ndarray, log_probability: np.ndarray, width: int, between: tuple[float, float] | None = None
) -> bytes:
    """The successors of each context with their quantised log probabilities.

    Pairs are in order of context, then successor. Tries with the same range ``between`` (their own
    values' where none is given) quantise alike, however pairs are dealt over them.
    """
    contexts, firsts = np.unique(context, return_index=True)
    n = len(log_probability)
    if between is None:
        between = (float(log_probability.min()), float(log_probability.max())) if n else (0.0, 0.0)
    levels = encode(contexts) + encode(np.append(firsts, n)) + encode(context.astype(np.int64) * width + successor)
    return levels + np.array(between, "<f8").tobytes() + pack(quantised(log_probability, *between), VALUE_BITS)


class Trie:
    """A memory-mapped trie."""

    def __init__(self, path: str, width: int):
        mapped = np.asarray(np.memmap(path, np.uint8, "r"))
        parts, at = [], 0
        for _ in range(3):
            parts.append(Sequence(mapped[at:]))
            at += parts[-1].size
        self.contexts, self.pointers, self.successors = parts
        self.between = tuple(float(x) for x in mapped[at : at + 16].view("<f8"))
        self.values = mapped[at + 16 :]
        self.width = width

    def find(self, context: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each pair is stored, and its quantised log probability.

        Equal pairs in a row are looked up once.
        """
        if not self.successors.n or not len(context):
            return np.zeros(len(context), bool), np.zeros(len(context))
        new = np.ones(len(context), bool)
        new[1:] = (context[1:] != context[:-1]) | (successor[1:] != successor[:-1])
        found, value = self._find(context[new], successor[new])
        run = np.cumsum(new) - 1
        return found[run], value[run]

    def _find(self, context: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.ones(len(context), bool)
        new[1:] = context[1:] != context[:-1]
        each, run = context[new], np.cumsum(new) - 1
        node = np.minimum(self.contexts.successor(each), self.contexts.n - 1)
        known = self.contexts.at(node) == each
        begin, end = self.pointers.at(node)[run], self.pointers.at(node + 1)[run]
        asked = np.flatnonzero(known[run])
        sought = context[asked] * self.width + successor[asked]
        place = self.successors.successor(sought)
        inside = np.flatnonzero((place >= begin[asked]) & (place < end[asked]))
        inside = inside[self.successors.at(place[inside]) == sought[inside]]
        found, value = np.zeros(len(context), bool), np.zeros(len(context))
        found[asked[inside]] = True
        value[asked[inside]] = restored(unpack(self.values, VALUE_BITS, place[inside]), *self.between)
        return found, value
