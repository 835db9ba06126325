"""Removal of repeated passages with a distributed difference-cover suffix sort.

A byte goes if a 50-byte string over it also starts in a document with a smaller id. Suffixes need to
be compared for 50 bytes only, and only where a passage may repeat, so the sort is split up:

* Any 50-byte string has a smallest 20-byte piece by hash (its minimizer). Equal strings have equal
  minimizers; runs of strings with one minimizer are one segment. Packed minimizers are counted
  over shards, and segments whose minimizer is in one document only are dropped.
* The other segments go, by minimizer, to shards. A shard sorts the suffixes of its segments with a
  difference cover modulo 3: sampled positions are named by triples of 8-byte characters, the
  names by triples of names (72 bytes, so one level of recursion is enough), the remaining
  suffixes are merged in, and neighbours are compared. Equal prefixes get their smallest id.
* Each group of documents looks its own segments up in the answers and cuts its texts.

A group sends equal segments once, with their smallest id, so copies and common passages are
reduced before they are shuffled.

Defined results: null and empty texts have no bytes and lose none; texts under 50 bytes are kept; rows
with equal ids do not remove each other; rows without an id have no place in the order: they lose nothing
and take nothing from others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import U64, byte_column, even_keys, mixed, numbers, powers, prefix_sums, shards, span_hashes, stored
from souk.llm.scoring import packed, planes, unpacked, unplanes

SPAN = 50
PIECE = 20
PIECES = SPAN - PIECE + 1
KEY_BITS = U64(24)  # minimizers are counted by the upper 40 bits of their hash; collisions only cost time
GROUP_BYTES = 4 << 20
SHARDS = 6  # per shuffle partition: a shard sorts a few megabytes at a time
SLICE = 1 << 20


class Runs:
    """Runs of 50-byte windows with one minimizer: text, first and last window, minimizer key."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.text, self.first, self.last, self.key = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),)
        n = len(data) - SPAN + 1
        if n <= 0:
            return
        lengths = np.diff(offsets)
        sums = prefix_sums(data)
        hashes = mixed((sums[PIECE:] - sums[:-PIECE]) * powers(len(sums))[1][: len(sums) - PIECE])
        bits = U64(max(24, len(data).bit_length()))
        low = (hashes >> bits << bits) | np.arange(len(hashes), dtype=U64)
        for step in (1, 2, 4, 8):
            low = np.minimum(low[:-step], low[step:])  # of 2, 4, 8, 16 pieces
        low = np.minimum(low[: n], low[PIECES - 16 : PIECES - 16 + n])
        place = (low & ((U64(1) << bits) - U64(1))).astype(np.int64)
        text = np.repeat(np.arange(len(lengths)), lengths)[:n]
        inside = np.arange(n) + SPAN <= offsets[text + 1]
        new = inside.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1] | (text[1:] != text[:-1])
        self.first = np.flatnonzero(new)
        ends = inside.copy()
        ends[:-1] &= new[1:] | ~inside[1:]
        self.last = np.flatnonzero(ends)
        self.text = text[self.first]
        self.key = hashes[place[self.first]] >> KEY_BITS
        self.sums = sums

    def only(self, chosen: np.ndarray) -> None:
        self.text, self.first, self.last, self.key = (x[chosen] for x in (self.text, self.first, self.last, self.key))

    def segments(self) -> np.ndarray:
        """Hash of each run's bytes."""
        return span_hashes(self.sums, self.first, self.last + SPAN) if len(self.first) else np.zeros(0, U64)


def parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts of a group, about a megabyte at a time: first and last text, bytes, offsets."""
    start = 0
    while start < len(offsets) - 1:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE, side="right")) - 1)
        stop = min(stop, len(offsets) - 1)
        yield start, stop, data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def squeeze(data: bytes) -> bytes:
    return zstandard.compress(data, 1)


def expand(data: bytes) -> bytes:
    return zstandard.decompress(data)


def _as_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _as_batch(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def _record(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = [list(x) for x in zip(*rows)] if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_record(schema, rows)])


GROUPS = "group long, shard long, keys binary, flags binary, rows binary"


def group_documents(docs: DataFrame, keys: list[int]) -> DataFrame:
    """Documents in packed groups, and each group's minimizers by shard."""
    names = np.array(keys)

    def emit(number: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, ends = byte_column(batch)
        found, texts = [], []
        for start, _, part, offsets in parts(data[ends[0] : ends[-1]], ends - ends[0]):
            runs = Runs(part, offsets)
            found.append(runs.key)
            texts.append(runs.text + start)
        key, text = np.concatenate(found), np.concatenate(texts)
        order = np.lexsort((text, key))
        key, text = key[order], text[order]
        new = np.diff(key, prepend=~key[:1]) != 0
        several = np.zeros(int(new.sum()), np.uint8)
        again = np.cumsum(new) - 1
        several[again[1:][~new[1:] & (text[1:] != text[:-1])]] = 1
        key = key[new]
        yield _record(GROUPS, [(number, None, None, None, _as_bytes(batch))])
        shard = (mixed(key) % U64(len(names))).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        edges = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
        rows = []
        for a, b in zip(edges, edges[1:]):
            run = order[a:b]
            rows.append((number, int(names[shard[run[0]]]), packed(key[run]), np.packbits(several[run]).tobytes(), None))
        yield _record(GROUPS, rows)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        waiting, held = [], 0
        for batch in batches:
            _, ends = byte_column(batch)
            start = 0
            while start < batch.num_rows:  # a group ends with the text that fills it
                stop = int(np.searchsorted(ends, ends[start] + GROUP_BYTES - held, side="left"))
                stop = min(max(stop, start + 1), batch.num_rows)
                waiting.append(batch.slice(start, stop - start))
                held += int(ends[stop] - ends[start])
                start = stop
                if held >= GROUP_BYTES:
                    yield from emit(part << 24 | count, pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
                    waiting, held, count = [], 0, count + 1
        if waiting:
            yield from emit(part << 24 | count, pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])

    return docs.where("doc_id is not null").mapInArrow(grouped, GROUPS)


CANDIDATES = "group long, shard long, keys binary"


def _candidates(table: pa.Table) -> pa.Table:
    """Minimizers of one shard that are in several documents, for each group that has them."""
    groups, shard = table.column("group").to_pylist(), table.column("shard")[0].as_py()
    keys = [unpacked(x) for x in table.column("keys").to_pylist()]
    flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(table.column("flags").to_pylist(), keys)]
    unique, at, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    several = counts > 1
    several[at[np.concatenate(flags) > 0]] = True
    chosen, rows, start = several[at], [], 0
    for group, key in zip(groups, keys):
        mine = key[chosen[start : start + len(key)]]
        start += len(key)
        if len(mine):
            rows.append((group, shard, packed(mine)))
    return _table(CANDIDATES, rows)


def _known_runs(data: np.ndarray, offsets: np.ndarray, candidates: np.ndarray) -> Runs:
    runs = Runs(data, offsets)
    if len(candidates):
        at = np.minimum(np.searchsorted(candidates, runs.key), len(candidates) - 1)
        runs.only(candidates[at] == runs.key)
    else:
        runs.only(np.zeros(len(runs.key), bool))
    return runs


def _group_segments(batch: pa.RecordBatch, candidates: np.ndarray, n_shards: int):
    """Of one group: bytes, offsets, ids, all candidate runs (in the group's bytes), their distinct
    segments in the order of (shard, hash), and the segment of each run."""
    data, ends = byte_column(batch)
    data, offsets = data[ends[0] : ends[-1]], ends - ends[0]
    found: list[list[np.ndarray]] = [[], [], [], [], []]
    for start, _, part, own in parts(data, offsets):
        runs = _known_runs(part, own, candidates)
        for column, value in zip(found, (runs.text + start, runs.first + offsets[start], runs.last + offsets[start], runs.key, runs.segments())):
            column.append(value)
    text, first, last, key, segment = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
    shard = (mixed(key.astype(U64)) % U64(n_shards)).astype(np.int64)
    order = np.lexsort((segment, shard))
    new = np.ones(len(order), bool)
    new[1:] = (segment[order][1:] != segment[order][:-1]) | (shard[order][1:] != shard[order][:-1])
    of_run = np.zeros(len(order), np.int64)
    of_run[order] = np.cumsum(new) - 1
    return data, offsets, numbers(batch, "doc_id").astype(np.int64), (text, first, last), order[new], shard[order[new]], of_run


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of many spans, one after the other."""
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return data[np.arange(int(lengths.sum())) + shift]


SEGMENTS = "group long, shard long, bytes binary, lengths binary, ids binary"


def send_segments(n_shards: int, names: np.ndarray):
    def send(rows: pa.Table, keys: pa.Table) -> pa.Table:
        if not rows.num_rows or not keys.num_rows:
            return _table(SEGMENTS, [])
        group = rows.column("group")[0].as_py()
        candidates = np.sort(np.concatenate([unpacked(x) for x in keys.column("keys").to_pylist()]))
        data, _, doc_ids, (text, first, last), unique, shard, of_run = _group_segments(
            _as_batch(rows.column("rows")[0].as_py()), candidates, n_shards
        )
        smallest = np.full(len(unique), np.iinfo(np.int64).max)
        np.minimum.at(smallest, of_run, doc_ids[text])
        lengths = last[unique] - first[unique] + SPAN
        edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
        out = []
        for a, b in zip(edges, edges[1:]):
            body = gather(data, first[unique[a:b]], lengths[a:b])
            out.append((
                group, int(names[shard[a]]), squeeze(body.tobytes()), squeeze(planes(lengths[a:b].astype(np.uint32))),
                squeeze(planes(smallest[a:b])),
            ))
        return _table(SEGMENTS, out)

    return send


def dense_ranks(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys (most significant first), and each element's name: equal keys, equal names."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new)
    return order, names


def sort_windows(data: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """``windows`` (starts of SPAN bytes) in suffix order, by a difference cover modulo 3."""
    n = len(data)
    body = np.concatenate([data, np.zeros(4 * SPAN, np.uint8)])
    chars = np.zeros(n + 3 * SPAN, U64)  # eight bytes as one character
    for k in range(8):
        chars = chars << U64(8) | body[k : k + len(chars)]
    # sampled triples
    sample = np.arange(n + SPAN + 2)
    sample = sample[sample % 3 != 0]
    name = np.zeros(n + 3 * SPAN, np.int64)
    name[sample] = dense_ranks([chars[sample], chars[sample + 8], chars[sample + 16]])[1]
    # the names' triples: 24 is a multiple of 3, so they stand at sampled positions again
    near = np.zeros(n + 3 * SPAN, bool)
    for k in range(3):
        near[windows + k] = True
    deep = np.flatnonzero(near)
    deep = deep[deep % 3 != 0]
    rank = np.zeros(n + 3 * SPAN, np.int64)
    rank[deep] = dense_ranks([name[deep] << 32 | name[deep + 24], name[deep + 48]])[1]
    # merge: each kind is in order by its own key, and each pair of kinds has a key in common
    kinds = [windows[windows % 3 == k] for k in range(3)]
    by_one = [body[w].astype(np.int64) << 40 | rank[w + 1] for w in kinds[:2]]
    by_two = {k: body[kinds[k]].astype(np.int64) << 48 | body[kinds[k] + 1].astype(np.int64) << 40 | rank[kinds[k] + 2] for k in (0, 2)}
    orders = [np.argsort(by_one[0], kind="stable"), np.argsort(rank[kinds[1]], kind="stable"), np.argsort(rank[kinds[2]], kind="stable")]
    kinds = [w[o] for w, o in zip(kinds, orders)]
    one = [key[o] for key, o in zip(by_one, orders)]
    two = {k: by_two[k][orders[k]] for k in (0, 2)}
    ranks = {k: rank[kinds[k]] for k in (1, 2)}
    place = [np.arange(len(w)) for w in kinds]
    place[0] = place[0] + np.searchsorted(one[1], one[0], "left") + np.searchsorted(two[2], two[0], "left")
    place[1] = place[1] + np.searchsorted(one[0], one[1], "right") + np.searchsorted(ranks[2], ranks[1], "left")
    place[2] = place[2] + np.searchsorted(two[0], two[2], "right") + np.searchsorted(ranks[1], ranks[2], "right")
    return np.concatenate(kinds)[np.argsort(np.concatenate(place), kind="stable")]


def same_as_before(data: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether each window has the bytes of the one before it in the order."""
    body = np.concatenate([data, np.zeros(8, np.uint8)])
    chars = np.zeros(len(data), U64)
    for k in range(8):
        chars = chars << U64(8) | body[k : k + len(data)]
    same = np.ones(len(windows), bool)
    same[:1] = False
    for at in (*range(0, SPAN - 8, 8), SPAN - 8):
        part = chars[windows + at]
        same[1:] &= part[1:] == part[:-1]
    return same


def smallest_ids(data: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For all windows of the segments, in order, the smallest id that has the window's bytes."""
    counts = lengths - SPAN + 1
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    total = int(counts.sum())
    owner = np.repeat(np.arange(len(lengths)), counts)
    windows = np.arange(total) - np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + starts[owner]
    order = sort_windows(data, windows)
    first = np.flatnonzero(~same_as_before(data, order))
    at = np.full(len(data) + 1, -1)
    at[windows] = np.arange(total)
    places = at[order]
    least = np.minimum.reduceat(ids[owner[places]], first)
    out = np.empty(total, np.int64)
    out[places] = np.repeat(least, np.diff(np.append(first, total)))
    return out


ANSWERS = "group long, shard long, keys binary"


def _answer(table: pa.Table) -> pa.Table:
    """Per group, in the order of its segments: windows with one smallest id, and that id."""
    groups, shard = table.column("group").to_pylist(), table.column("shard")[0].as_py()
    bodies = [np.frombuffer(expand(x), np.uint8) for x in table.column("bytes").to_pylist()]
    lengths = [unplanes(expand(x), np.uint32).astype(np.int64) for x in table.column("lengths").to_pylist()]
    ids = np.concatenate([unplanes(expand(x), np.int64) for x in table.column("ids").to_pylist()])
    data, sizes = np.concatenate(bodies), np.concatenate(lengths)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    hashes = span_hashes(prefix_sums(data), starts, starts + sizes)
    _, chosen, at = np.unique(hashes, return_index=True, return_inverse=True)
    smallest = np.full(len(chosen), np.iinfo(np.int64).max)
    np.minimum.at(smallest, at, ids)
    own_sizes = sizes[chosen]
    counts = own_sizes - SPAN + 1
    window_ids = np.repeat(smallest, counts)
    # a segment whose minimizer no other segment has shares no window with one
    key = _first_minimizers(data, starts[chosen])
    _, of_key, shared = np.unique(key, return_inverse=True, return_counts=True)
    several = np.flatnonzero(shared[of_key] > 1)
    if len(several):
        found = smallest_ids(gather(data, starts[chosen][several], own_sizes[several]), own_sizes[several], smallest[several])
        window_ids[np.repeat(shared[of_key] > 1, counts)] = found
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    new = np.diff(window_ids, prepend=-1) != 0
    new[firsts] = True
    begin = np.flatnonzero(new)
    run_sizes, run_ids = np.diff(np.append(begin, len(window_ids))), window_ids[begin]
    run_first = np.searchsorted(begin, firsts)
    run_count = np.diff(np.append(run_first, len(begin)))
    rows, start = [], 0
    for group, own in zip(groups, lengths):
        mine = at[start : start + len(own)]
        start += len(own)
        n = run_count[mine]
        place = np.arange(int(n.sum())) + np.repeat(run_first[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        parts_ = (planes(run_sizes[place].astype(np.uint32)), planes(run_ids[place]))
        rows.append((group, shard, squeeze(len(place).to_bytes(8, "little") + b"".join(parts_))))
    return _table(ANSWERS, rows)


def _first_minimizers(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The smallest piece hash in the first window of each segment."""
    sums = prefix_sums(data)
    least = None
    for k in range(PIECES):
        value = span_hashes(sums, starts + k, starts + k + PIECE)
        least = value if least is None else np.minimum(least, value)
    return least


def cut_group(n_shards: int, names: np.ndarray, fields: list[str]):
    """Removes what the answers say from the texts of one group."""
    number = {int(name): i for i, name in enumerate(names)}

    def cut(rows: pa.Table, told: pa.Table) -> pa.Table:
        batch = _as_batch(rows.column("rows")[0].as_py())
        keys = told.column("kind").to_pylist()
        blobs, of_shard = told.column("keys").to_pylist(), told.column("shard").to_pylist()
        candidates = [unpacked(x) for x, kind in zip(blobs, keys) if kind == 0]
        candidates = np.sort(np.concatenate(candidates)) if candidates else np.zeros(0, U64)
        data, offsets, doc_ids, (text, first, last), unique, _, of_run = _group_segments(batch, candidates, n_shards)
        window_ids, segment_first = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(unique):
            sizes, ids = [], []
            for _, blob in sorted((number[s], x) for x, s, kind in zip(blobs, of_shard, keys) if kind == 1):
                blob = expand(blob)
                n = int.from_bytes(blob[:8], "little")
                sizes.append(unplanes(blob[8 : 8 + 4 * n], np.uint32).astype(np.int64))
                ids.append(unplanes(blob[8 + 4 * n :], np.int64))
            window_ids = np.repeat(np.concatenate(ids), np.concatenate(sizes))
            segment_first = np.concatenate([[0], np.cumsum((last - first + 1)[unique])[:-1]])
        # a megabyte of text at a time: the arrays have several numbers for each byte
        removed, touched = np.zeros(len(data), bool), np.zeros(len(data), bool)
        for start, stop, part, own in parts(data, offsets):
            runs = slice(*np.searchsorted(text, [start, stop]))
            base, n = offsets[start], (last - first + 1)[runs]
            if not len(n):
                continue
            inner = np.arange(int(n.sum())) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            gone = window_ids[inner + np.repeat(segment_first[of_run[runs]], n)] < np.repeat(doc_ids[text[runs]], n)
            begun = np.zeros(len(part) + 1, np.int32)
            begun[(inner + np.repeat(first[runs] - base, n))[gone]] = 1
            covered = begun.copy()
            covered[SPAN:] -= begun[:-SPAN]
            here = np.cumsum(covered[:-1], dtype=np.int32) > 0
            removed[base : base + len(part)] = here
            touched[base : base + len(part)] = _whole_characters(part, here)
        before = np.concatenate([[False], removed[:-1]]) if len(removed) else removed
        before[offsets[:-1][offsets[:-1] < len(removed)]] = False
        lost, spans = _counted(removed, offsets), _counted(removed & ~before, offsets)
        kept = pa.Array.from_buffers(
            pa.large_binary(), len(doc_ids), [None, pa.py_buffer(offsets - lost), pa.py_buffer(data[~removed])]
        ).cast(pa.binary())
        # characters that lost no byte, for text that stays text
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"}
        columns |= {
            "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(np.diff(lost)),
            "n_spans": pa.array(np.diff(spans)), "kept": kept, "text": _texts(batch, data, offsets, touched),
        }
        return pa.table({name: columns[name] for name in fields})

    return cut


def _counted(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set before each offset."""
    counts = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, dtype=np.int32, out=counts[1:])
    return counts[offsets].astype(np.int64)


def _whole_characters(data: np.ndarray, removed: np.ndarray) -> np.ndarray:
    """The bytes of all characters that lost one."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(starts):
        return removed
    return np.repeat(np.logical_or.reduceat(removed, starts), np.diff(np.append(starts, len(data))))


def _texts(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, removed: np.ndarray) -> pa.Array:
    """The texts without the removed bytes; null stays null."""
    ends = offsets - _counted(removed, offsets)
    texts = pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data[~removed])]
    ).cast(pa.string())
    null = batch.column(batch.schema.get_field_index("text")).is_null()
    return pa.compute.if_else(null, pa.scalar(None, pa.string()), texts)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, ``text`` without the characters of repeated passages, and for the
    bytes ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes, which replace columns of
    these names."""
    spark = docs.sparkSession
    keys = even_keys(spark, SHARDS * shards(spark))
    names = np.array(keys)
    table = stored(group_documents(docs, keys), "text-groups")
    rows = table.where("rows is not null").select("group", "rows")
    minimizers = table.where("rows is null").select("group", "shard", "keys", "flags")
    candidates = stored(minimizers.groupBy("shard").applyInArrow(_candidates, CANDIDATES), "candidates")
    by_group = lambda left, right: left.groupBy("group").cogroup(right.groupBy("group"))
    segments = by_group(rows, candidates).applyInArrow(send_segments(len(keys), names), SEGMENTS)
    answers = segments.groupBy("shard").applyInArrow(_answer, ANSWERS)
    told = candidates.withColumn("kind", F.lit(0)).union(answers.withColumn("kind", F.lit(1)))
    extra = "n_bytes long, n_removed long, n_spans long, kept binary"
    kept = [f for f in docs.schema.fields if f.name not in ("n_bytes", "n_removed", "n_spans", "kept")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", {extra}"
    fields = [f.name for f in kept] + [x.split()[0] for x in extra.split(", ")]
    cut = by_group(rows, told).applyInArrow(cut_group(len(keys), names, fields), schema)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    none = F.lit(0).cast("long")
    whole = [F.length(data).cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), data.alias("kept")]
    unnumbered = docs.where("doc_id is null").select(*[docs[f"`{f.name}`"] for f in kept], *whole)
    return cut.union(unnumbered)
