"""The cut of a group takes numbers for each byte of a part of its texts, not of all."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from souk.llm import suffix


def group():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghé", k=rng.randint(2, 9))) for _ in range(5000)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    passages = [prose(60) for _ in range(50)]
    texts, size = [None, "", "short"], 0
    while size < suffix.GROUP_BYTES:
        texts.append(f"{prose(rng.randint(50, 900))} {rng.choice(passages)} {prose(40)}")
        size += len(texts[-1].encode())
    return texts


def test_cut_takes_little_memory():
    """It held 213 MB for a group of 4 MB of text."""
    texts = group()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    rows = pa.table({"group": [0], "rows": pa.array([suffix._as_bytes(batch)], pa.binary())})
    data, ends = suffix.byte_column(batch)
    found, counts = np.unique(np.concatenate([suffix.Runs(p, o).key for _, _, p, o in suffix.parts(data, ends)]), return_counts=True)
    keys = pa.table({"group": [0], "shard": [0], "keys": pa.array([suffix.packed(found[counts > 1])], pa.binary())})
    names = np.arange(1)
    answer = suffix._answer(suffix.send_segments(1, names)(rows, keys))
    told = pa.concat_tables([t.append_column("kind", pa.array([k] * t.num_rows, pa.int64())) for k, t in enumerate((keys, answer))])
    cut = suffix.cut_group(1, names, ["doc_id", "text", "n_removed"])
    cut(rows, told)
    tracemalloc.start()
    out = cut(rows, told)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(out.column("n_removed").to_pylist()) > 100_000
    assert out.column("text").to_pylist()[:3] == texts[:3]
    assert peak < 30 * suffix.GROUP_BYTES
