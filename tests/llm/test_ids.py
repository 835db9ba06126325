"""Missing and repeated ids, clashing columns: every row has a result, by its own text."""

import hashlib
import random

import corpus_pipeline
import pytest
from brute import near_names, removed
from pyspark.sql import functions as F

from souk.llm import bpe, langid, licenses, minhash, packing, quality_rules, scoring, secrets, suffix
from test_documents import BYTE_BPE, WORD_BPE

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, rep long, `group` long, kept string, number long"


def rows():
    rng = random.Random(21)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    texts = [prose(80) for _ in range(8)]
    near = [t + " more" for t in texts]
    ids = [
        (1, texts[0]), (1, texts[1]), (3, near[1]),  # the second text of a repeated id has a near copy
        (None, texts[2]), (4, near[2]), (None, texts[2]),  # one class with and without ids
        (None, texts[3]), (None, near[3]),  # a class without any id
        (5, texts[4]), (5, texts[4]), (2, near[4]), (6, None), (6, ""), (None, None), (None, ""), (None, "one two"), (7, "one two"),
        ((1 << 53) + 1, texts[5]), (1 << 53, near[5]), (-3, texts[6]), (None, texts[7]), (9, "word " * 60),
    ]
    return [(i, t, "en" if i else None, "s", len(t or ""), "d", 8, 9, "x", 3) for i, t in ids]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


def key(x):
    return str(x)


def test_near_duplicates_by_text(docs):
    expected = [(r[0], *named) for r, named in zip(rows(), near_names(rows()))]
    assert sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=key) == sorted(expected, key=key)
    assert sum(not kept for *_, kept in expected) >= 5


def test_pipeline_keeps_other_texts_of_an_id(spark, docs):
    judged = near_names(rows())
    kept = [(r[0], r[1]) for r, (_, stays) in zip(rows(), judged) if stays]
    after = corpus_pipeline.near_dedup(spark, docs, "")
    assert after.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in after.collect()), key=key) == sorted(kept, key=key)


def test_passages_of_rows_without_id(docs):
    """They lose nothing and take nothing; the others are as if they were not there."""
    fixture = [r for r in rows() if r[0] != 5 and r[0] != 6 and r[0] != 1 and r[0] is not None]
    lone = [r for r in rows() if r[0] is None]
    alone = removed(fixture)
    some = docs.where("doc_id is null or doc_id not in (1, 5, 6)")
    found = suffix.remove_repeats(some).collect()
    assert len(found) == len(fixture) + len(lone)
    for r in found:
        if r["doc_id"] is not None:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) == alone[r["doc_id"]]
    whole = sorted((bytes(r["kept"]).decode(), r["n_bytes"], r["n_removed"], r["n_spans"], r["text"]) for r in found if r["doc_id"] is None and r["text"])
    assert whole == sorted((r[1], len(r[1]), 0, 0, r[1]) for r in lone if r[1])


def test_scores_of_rows_without_id(docs):
    found = scoring.score_documents(docs).collect()
    assert sorted((r["doc_id"] for r in found), key=key) == sorted((r[0] for r in rows()), key=key)
    assert all(r["held_out"] is None for r in found if r["doc_id"] is None)
    assert len({r["train_tokens"] for r in found}) == 1
    counted = sorted((len((r[1] or "").split()) + 1, r[0] is None) for r in rows())
    assert sorted((r["n_tokens"], r["doc_id"] is None) for r in found) == counted


@pytest.mark.parametrize("operator", [
    langid.identify_languages, lambda d: bpe.encode_documents(d, BYTE_BPE), quality_rules.quality_verdicts, secrets.scan_secrets,
    licenses.scan_licenses, lambda d: packing.pack_documents(d, WORD_BPE).where("start = 0"),
])
def test_a_row_for_each_document(docs, operator):
    found = operator(docs).groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    ids = [r[0] for r in rows()]
    assert {r["doc_id"]: r["n"] for r in found} == {i: ids.count(i) for i in ids}


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1])
def test_stages_run_on_them(spark, docs, stage):
    assert stage[1](spark, docs, "").columns == docs.columns
