import math

import numpy as np
import pytest

from brute import classes
from souk.llm import embeddings
from souk.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, dims string"


def fixture_rows(n=700, dims=8, seed=2):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(25, dims))
    rows = []
    for i in range(n):
        v = centers[i % 25] + rng.normal(scale=0.16, size=dims)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 3)) if i % 3 else 0, "x"))
    rows += [(n + i, rows[0][1], 0, "x") for i in range(30)]
    rows += [(n + 40, [2 * x for x in rows[0][1]], 0, "x")]
    odd = [None, [], [0.0] * dims, [1.0, None] + [0.0] * (dims - 2), [math.nan] * dims, [math.inf] + [0.0] * (dims - 1)]
    rows += [(n + 50 + i, v, 0, "x") for i, v in enumerate(odd)]
    rows += [(n + 60, rows[0][1], None, "x"), (n + 61, rows[0][1][:4], 0, "x"), (n + 62, rows[0][1][:4], 0, "x")]
    return rows


def brute(rows):
    good = [r for r in rows if r[1] and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    linked, count = [], {r[0]: 0 for r in rows}
    for i, a in enumerate(good):
        for b in good[:i]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                    linked.append((a[0], b[0]))
                    count[a[0]] += 1
                    count[b[0]] += 1
    return count, classes([r[0] for r in rows], linked)


@pytest.mark.parametrize("block", [16, 256])
def test_near_vectors(spark, monkeypatch, block):
    rows = fixture_rows()
    monkeypatch.setattr(embeddings.grid_blocks, "__defaults__", (block,))
    count, least = brute(rows)
    found = {r["vec_id"]: r for r in embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert len(found) == len(rows)
    assert {i: r["n_links"] for i, r in found.items()} == count
    assert {i: r["component_id"] for i, r in found.items()} == least
    assert sum(count.values()) > 2000
    assert all(r["kept"] == (i == r["component_id"]) for i, r in found.items())


def test_no_vectors(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_halving_skips_nothing_near():
    rng = np.random.default_rng(4)
    x = embeddings.unit(np.repeat(rng.normal(size=(20, 6)), 20, axis=0) + rng.normal(scale=0.1, size=(400, 6)))
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :3]
    assert (embeddings.linked_cells(x[:250], x[250:], axes, 0.98) == (x[:250] @ x[250:].T >= 0.98)).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 101), (102, 101), (50, 50)] + [(200, 200 + i) for i in range(1, 40)]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert found == {**{i: 0 for i in range(21)}, **{i: 100 for i in (100, 101, 102)}, **{200 + i: 200 for i in range(40)}}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_missing_and_repeated_ids_and_text_labels(spark):
    """Every vector counts for itself, whatever its id; labels are compared as they are."""
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(12, 6))
    vectors = [centers[i % 12] + rng.normal(scale=0.05, size=6) for i in range(150)]
    vectors += [vectors[3], vectors[3], vectors[20]]
    labels = [["red", "1", "01"][i // 12 % 3] for i in range(len(vectors))]
    ids = [None if i % 7 == 0 else i // 2 for i in range(len(vectors))]  # pairs of rows share an id
    numbered = [(i, [float(x) for x in v], label) for i, (v, label) in enumerate(zip(vectors, labels))]
    count, least = brute(numbered)
    members = {}
    for i, root in least.items():
        members.setdefault(root, []).append(ids[i])
    name = {root: min((x for x in found if x is not None), default=None) for root, found in members.items()}
    expected = [(ids[i], count[i], name[least[i]], ids[i] == name[least[i]]) for i in range(len(vectors))]
    rows = [(ids[i], v, label, "x") for i, v, label in numbered]
    found = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, rep string").repartition(3))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert sum(count.values()) > 100
