"""Lexical search against a plain version."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import frame, rows_of
from pyspark.sql import functions as F

from souk.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranking(rows, items, k=50):
    """(item, rank, doc_id, score) of every item, by scoring every row."""
    counts = [(r[0], Counter(terms_of(r[1]))) for r in rows]
    n_docs = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    holders = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in counts:
            size, score = sum(c.values()), 0
            for t in set(terms_of(text)) & set(c):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1)))
                score += weight * (10**9 * c[t] // (1000 * c[t] + 20 * (50 + 50 * size * n_docs // total)))
            if score > 0:
                found.append((-score, doc is None, doc, score))
        out += [(item, i, doc, score) for i, (_, _, doc, score) in enumerate(sorted(found, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = ["the", "of", *("".join(rng.choices("abcdeéß1", k=rng.randint(1, 6))) for _ in range(150))]
    prose = lambda n: rng.choice([" ", ", ", "-"]).join(rng.choices(words, k=n))
    texts = [prose(int(rng.paretovariate(0.7) * 10) % 3000 + 1) for _ in range(400)]
    texts += [texts[3]] * 120 + [None, "", "!!", "ONE two", "one TWO", "漢字 é", "\x00", prose(30_000)]
    found = rows_of(texts)
    found += [(None, texts[5], "en", "s", 1, "x", 1), (None, "one two", "en", "s", 1, "x", 1)]
    return found + [found[7], found[7], (9, "one two three", "en", "s", 1, "x", 1)]


@pytest.fixture(scope="module")
def items(rows):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(terms_of(rows[rng.randrange(300)][1]), k=30)) for _ in range(20)]
    texts += [rows[3][1], "ONE Two", None, "", "absent9", "the the the", rows[407][1], "漢字"]
    return [(i, t) for i, t in enumerate(texts)] + [(1, texts[2]), (None, texts[4])]


@pytest.mark.parametrize("block", [3, 256])
def test_same_ranking(spark, monkeypatch, rows, items, block):
    monkeypatch.setattr(lexical, "ITEMS", max(block, 20))  # several blocks of items, blocks of documents
    monkeypatch.setattr(lexical, "BLOCK", block)
    asked = spark.createDataFrame([(*x, "clash", 1) for x in items], "item_id long, text string, doc_id string, score int")
    docs = frame(spark, rows).withColumns({"item_id": F.lit(7), "key": F.lit("x"), "rank": F.lit(1)}).repartition(3)
    found = sorted(map(tuple, lexical.rank_documents(docs, asked).collect()), key=str)
    assert found == ranking(rows, items)


def test_nothing_to_rank(spark, rows):
    none, one = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([(1, "the")], "item_id long, text string")
    for docs, asked in ((frame(spark, rows), none), (frame(spark, []), one), (frame(spark, rows_of(["", None])), one)):
        found = lexical.rank_documents(docs, asked)
        assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_hold_and_exclude(spark, rows):
    """No bound is below its score, and documents that share few terms are left out."""
    docs = frame(spark, rows)
    index = lexical.build_index(docs)
    item = [(0, rows[3][1])]
    queries = lexical.Queries.of([r for r in spark.createDataFrame(item, "item_id long, text string").collect()], lexical.pa.int64())
    totals = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    queries.weigh(lexical.holders_of(index, queries), totals["n"], totals["l"])
    weights = queries.matrix()
    bound = {}
    for row in index.where("width is not null").collect():
        values = lexical.block_bounds(row.asDict(), queries, weights)[0]
        bound.update({(i, s): max(int(v), bound.get((i, s), 0)) for i, s, v in zip(row["ids"], row["sizes"], values)})
    sizes = {r[0]: len(terms_of(r[1])) for r in rows[:400]}
    for _, _, doc, score in ranking(rows[:], item, 10_000):
        if doc in sizes and doc not in (7, 9):
            assert bound[doc, sizes[doc]] >= score
    best = ranking(rows, item)
    beat = min(s for *_, s in best)
    limits = (np.array([beat]), np.array([max(d for _, _, d, s in best if s == beat)]))
    asked = lexical.candidates(index, queries, 50, limits).count()
    assert 50 <= asked < len(rows) // 2
