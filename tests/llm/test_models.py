"""Language filter, importance model and packing plan against plain versions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import zlib
from hypothesis import given, settings
from hypothesis import strategies as st
from test_documents import WORD_BPE, by_id

from souk.llm import langid, packing, quality_model


def grams(text):
    """Four bytes of the text between spaces, without two spaces in a row."""
    data = b" " + bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in (text or "").encode().lower()) + b" "
    return [data[i : i + 4] for i in range(len(data) - 3) if b"  " not in data[i : i + 4]]


def language_shares(rows):
    """Language -> share of each text's n-grams that the language contains, by sets."""
    counts = defaultdict(Counter)
    for doc, text, lang in rows:
        if lang is not None and text is not None and zlib.crc32(str(doc).encode()) % 3 != 1:
            counts[lang].update(grams(text))
    rate = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    most = Counter()
    for of in rate.values():
        for g, r in of.items():
            most[g] = max(most[g], r)
    known = {lang: {g for g, r in of.items() if r >= langid.MIN_SHARE * most[g]} for lang, of in rate.items()}
    return {doc: {lang: sum(g in known[lang] for g in grams(text)) / max(len(grams(text)), 1) for lang in sorted(known)} for doc, text, _ in rows}


def language_rows(seed=11):
    rng = random.Random(seed)
    words = {lang: ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(300)]
             for lang, letters in (("aa", "abcdefg"), ("bb", "defghij"), ("cc", "abcxyz"), ("dd", "дежзиé"))}
    rows = []
    for i in range(240):
        lang = rng.choice(sorted(words))
        text = " ".join(rng.choices(words[lang], k=rng.randint(1, 60)))
        if i % 9 == 0:  # a foreign passage
            text += ". " + " ".join(rng.choices(words["bb"], k=10))
        rows.append((i, text, None if i % 17 == 0 else lang))
    return [*rows, (900, "rare", "aa"), (901, "RARE rare", None)]


def test_languages_against_sets(spark):
    rows = language_rows()
    found = by_id(langid.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)))
    for doc, shares in language_shares(rows).items():
        _, lang, score = found[doc]
        total = sum(shares.values())
        wrong = 0.02 + 2 / max(len(grams(dict((r[0], r[1]) for r in rows)[doc])), 1)  # a false positive or two
        assert score == pytest.approx(shares[lang] / total, abs=wrong)
        assert shares[lang] >= max(shares.values()) - wrong


def test_filter_has_every_gram_of_a_language(spark):
    rows = language_rows()
    model = langid.learn_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        if lang:
            counts[lang].update(grams(text))
    rate = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    for i, lang in enumerate(model.languages):
        own = [g for g in rate[lang] if rate[lang][g] >= langid.MIN_SHARE * max(of.get(g, 0) for of in rate.values())]
        masks = model.masks(np.array([int.from_bytes(g, "big") for g in own], np.uint64))
        assert (masks[0] >> masks.dtype.type(i) & masks.dtype.type(1)).all()
    assert (model.false_rate < 0.02).all()


@pytest.mark.parametrize("bits", [6, 24])
def test_full_and_wide_filters(spark, monkeypatch, bits):
    """A filter at its largest size still has a result for every text."""
    monkeypatch.setattr(langid, "MAX_BITS", bits)
    rows = language_rows()
    found = by_id(langid.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert len(found) == len(rows) and all(0 <= v[2] <= 1 for v in found.values())


def test_equal_shares_go_to_the_first_name(spark):
    rows = [(i, "same words here", lang) for i, lang in enumerate(["zz", "yy"] * 6)]
    found = by_id(langid.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert {v[1] for v in found.values()} == {"yy"}


def test_importance_is_the_ratio_of_the_models(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta"]
    rows = [(i, " ".join(rng.choices(words[: 3 + i % 4], k=rng.randint(1, 30)))) for i in range(60)] + [(60, None), (61, "  ")]
    good = {i for i in range(0, 40, 4)}
    features = lambda text: [*(w := (text or "").split()), *zip(w, w[1:])]
    raw, target = Counter(), Counter()
    for i, text in rows:
        raw.update(features(text))
        if i in good:
            target.update(features(text))
    share = lambda c, x: (c[x] + 1) / (sum(c.values()) + quality_model.BUCKETS)
    expected = {i: sum(math.log(share(target, x) / share(raw, x)) for x in features(text)) for i, text in rows}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i in good)) for i in range(40)], "doc_id long, quality int")
    found = by_id(quality_model.sample_by_importance(docs, labels, k=20))
    for i, text in rows[:60]:
        assert found[i][0] == pytest.approx(expected[i], abs=1e-9)
    assert found[60][0] == found[61][0] == quality_model.LOWEST
    ranked = sorted(found, key=lambda i: (-found[i][1], i))
    assert {i for i, v in found.items() if v[2]} == set(ranked[:20])


def test_ties_at_the_border_go_to_the_smaller_id(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "same") for i in (9, 4, 7, 4, 1)], "doc_id long, text string")
    real = quality_model.importances
    flat = lambda d, r: real(d, r).withColumn("sample_key", quality_model.F.lit(0.5))
    monkeypatch.setattr(quality_model, "importances", flat)
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    chosen = quality_model.sample_by_importance(docs, labels, k=2).where("selected").collect()
    assert {r["doc_id"] for r in chosen} == {1, 4}


LENGTHS = st.dictionaries(st.one_of(st.integers(1, 255), st.integers(32, 512).map(lambda k: 8 * k)), st.integers(1, 300), min_size=1, max_size=12)


@settings(max_examples=15, deadline=None)
@given(LENGTHS)
def test_units_hold_all_pieces(lengths):
    plan = packing.unit_plan(lengths)
    filled, pieces = Counter(), Counter()
    for i, (length, first, each, ahead, per, sequence) in enumerate(plan):
        after = plan[i + 1][1] if i + 1 < len(plan) and plan[i + 1][0] == length else lengths[length]
        assert first == pieces[length]
        pieces[length] += after - first
        for rank in range(first, after):
            filled[sequence + ((rank - first) // each + ahead) // per] += length
    assert pieces == lengths
    assert max(filled.values()) <= 4096 and sorted(filled) == list(range(len(filled)))


def test_short_documents_leave_little_padding(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "CAST(NULL AS string) AS text")
    assert packing.pack_documents(docs, WORD_BPE).select("sequence_id").distinct().count() == 2
    short = spark.range(6000).selectExpr("id AS doc_id", "repeat('word ', CAST(id % 37 AS int)) AS text")
    packed = packing.pack_documents(short, WORD_BPE).groupBy("sequence_id").agg({"length": "sum"}).collect()
    total = sum(r[1] for r in packed)
    assert max(r[1] for r in packed) <= 4096 and len(packed) <= -(-total // 4096) + 1
