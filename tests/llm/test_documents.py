"""Operators on documents against plain versions, on fixtures with all the odd rows."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from brute import base_scores, frame, near_classes, pair_scores, probability_jaccard, removed, repeat_words, rows_of, shingles
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from souk.llm import bpe, elias_fano, langid, minhash, packing, quality_model, quality_rules, scoring, suffix

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def corpus(seed=1):
    rng = random.Random(seed)
    words = ["the", "of", "and", *("".join(rng.choices("abcdeéß", k=rng.randint(2, 7))) for _ in range(300))]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    texts = [prose(rng.randint(60, 200)) for _ in range(25)]
    passage = prose(30)
    for i in range(6):  # near copies, chains of them, shared passages
        base = texts[i].split()
        base[rng.randrange(len(base))] = "changed"
        texts.append(" ".join(base))
        base[rng.randrange(len(base))] = "again"
        texts.append(" ".join(base))
        texts.append(f"{prose(20)} {passage} {prose(20)}")
    texts += [texts[0]] * 3 + [None, "", None, "   ", "one two", "one two", "a", "\n\n", "Ünïcödé ∑ 漢字 漢字"]
    texts += ["line of words here\n" * 30, "spam " * 300, "<|endoftext|> a<|endoftext|>", prose(5000)]
    return rows_of(texts)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def by_id(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_near_duplicates(docs, rows, empty):
    found = by_id(minhash.near_duplicates(docs))
    expected = near_classes(rows)
    assert {k: v[0] for k, v in found.items()} == expected
    assert all(kept == (k == c) for k, (c, kept) in found.items())
    assert len(set(expected.values())) < len(rows) - 5
    assert minhash.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("block", [6, 128])
def test_near_duplicates_in_one_large_group(spark, monkeypatch, block):
    """Members of one cluster that pass with different hubs, or stand in different blocks, still meet."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash.block_links, "__defaults__", (block,))
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"x{rng.randrange(400)}"
        rows.append((i, " ".join(words)))
    found = by_id(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert {k: v[0] for k, v in found.items()} == near_classes(rows)


def test_registers_agree_as_often_as_similarity_says():
    x = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 2 + "1 2 3 4 5 6 7 8 9"
    y = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3 + "5 6 7 8 9 10 11"
    data = (x + y).encode()
    doc, key, count = minhash.shingles(np.frombuffer(data, np.uint8), np.array([0, len(x), len(data)]))
    found = minhash.signatures(doc, key, count.astype(float), 2, registers=20_000)
    exact = probability_jaccard(shingles(x), shingles(y))
    assert abs((found[0] == found[1]).mean() - exact) < 0.02
    assert minhash.probability_jaccard((key[doc == 0], count[doc == 0]), (key[doc == 1], count[doc == 1])) == pytest.approx(exact)


def test_suffix_dedup(docs, rows, empty):
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in suffix.remove_repeats(docs).collect()}
    assert found == removed(rows)
    assert sum(v[1] for v in found.values()) > 5000
    assert suffix.remove_repeats(empty).collect() == []


def test_suffix_dedup_keeps_columns_and_characters(spark):
    rows = rows_of(["é" * 60, "x" + "é" * 60, None])
    out = {r["doc_id"]: r for r in suffix.remove_repeats(frame(spark, rows)).collect()}
    assert out[1]["text"] == "x" and out[2]["text"] is None and out[0]["text"] == "é" * 60
    assert out[1]["group"] == 1 and out[1]["source"] == "s"


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("ab", min_size=50, max_size=90), min_size=1, max_size=6))
def test_smallest_ids_of_windows(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    lengths, ids = np.array([len(t) for t in texts]), np.arange(len(texts))[::-1].copy()
    expected = {}
    for t, i in zip(texts, ids):
        for k in range(len(t) - 49):
            expected[t[k : k + 50]] = min(expected.get(t[k : k + 50], i), i)
    found = suffix.smallest_ids(data, lengths, ids)
    assert found.tolist() == [expected[t[k : k + 50]] for t in texts for k in range(len(t) - 49)]


def test_language_id(spark, docs, empty):
    rng = random.Random(3)
    letters = {"xx": "abcde ", "yy": "defgh ", "zz": "ßéàü "}
    rows = [(i, "".join(rng.choices(letters[lang], k=120)), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 40)]
    rows += [(200, None, "xx"), (201, "12 34 !", "yy"), (202, "", None), (203, "a", None), (204, "漢", None)]
    found = by_id(langid.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert len(found) == len(rows)
    assert all(found[i][1] == lang for i, _, lang in rows[:120])
    assert [found[i][1] for i in (200, 201, 202)] == ["und"] * 3 and found[203][1] != "und"
    assert all(0 <= v[2] <= 1 for v in found.values())
    assert found[2][0] == (zlib.crc32(b"2") % 3 == 1)
    assert langid.identify_languages(empty).collect() == []
    assert langid.identify_languages(docs).count() == docs.count()


def test_more_languages_than_a_word_has_bits(spark):
    rng = random.Random(5)
    letters = ["".join(chr(0x4E00 + 8 * lang + i) for i in range(5)) + " " for lang in range(70)]
    rows = [(i, "".join(rng.choices(letters[i % 70], k=200)), f"l{i % 70:02}") for i in range(420)]
    found = by_id(langid.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert all(found[i][1] == lang for i, _, lang in rows)


def test_quality_sample(spark, empty):
    good, bad = "plain words of a good text here " * 20, "$$$ BUY!! now!! $$$ "
    rows = [(i, good if i % 4 else bad * 20) for i in range(200)] + [(200, None), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 if i % 4 else 0, 0) for i in range(0, 100)] + [(999, 1, 0), (1, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    found = by_id(quality_model.sample_by_importance(docs, labels, k=150))
    assert len(found) == 202 and not any(v[2] for i, v in found.items() if i % 4 == 0 and i < 200)
    some = by_id(quality_model.sample_by_importance(docs, labels, k=17))
    ranked = sorted(some, key=lambda i: (-some[i][1], i))
    assert {i for i, v in some.items() if v[2]} == set(ranked[:17])
    assert not any(v[2] for v in by_id(quality_model.sample_by_importance(docs, labels, k=0)).values())
    assert quality_model.sample_by_importance(empty, labels).collect() == []
    assert all(v[2] for v in by_id(quality_model.sample_by_importance(docs, labels.limit(0))).values())


def test_noise_does_not_follow_the_draw_of_targets(spark):
    docs = spark.createDataFrame([(i, "a text") for i in range(400)], "doc_id long, text string")
    keys = quality_model.importances(docs, np.zeros(quality_model.BUCKETS))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(quality_model.SEED)), F.lit(1 << 52)).alias("draw")
    table = keys.select("sample_key", draw).toPandas()
    assert abs(table["sample_key"].corr(table["draw"].astype(float))) < 0.3


def test_scores(docs, rows, empty):
    found = by_id(scoring.score_documents(docs))
    for doc, (held, n, known, total, base) in base_scores(rows).items():
        assert found[doc][:4] == (held, n, known, total)
        assert found[doc][4] == pytest.approx(base, rel=1e-9)
    assert scoring.score_documents(empty).collect() == []


@pytest.mark.parametrize("frequent", [1, 9, 40, scoring.VOCABULARY])
def test_all_pairs_count_whatever_is_frequent(spark, monkeypatch, frequent):
    rng = np.random.default_rng(frequent)
    texts = [" ".join(f"w{int(60 * x**3)}" for x in rng.random(rng.integers(0, 30))) for _ in range(60)]
    rows = rows_of([*texts, None, "", "never seen", "w1 never w2"])
    monkeypatch.setattr(scoring, "VOCABULARY", frequent)
    found = by_id(scoring.score_documents(frame(spark, rows)))
    for doc, (held, n, known, total, base) in base_scores(rows).items():
        assert found[doc][:4] == (held, n, known, total)
        assert found[doc][4] == pytest.approx(base, rel=1e-9)
    # values of twelve bits
    for doc, score in pair_scores(rows).items():
        assert found[doc][5] == pytest.approx(score, rel=2e-3)


@pytest.mark.parametrize("frequent", [39, 40])
def test_scores_of_a_flat_vocabulary_at_the_limit(spark, monkeypatch, frequent):
    # 39 words and the end mark; with one word too many, all words tie at the border
    rng = np.random.default_rng(3)
    rows = rows_of([" ".join(f"w{i}" for i in rng.permutation(39)) for _ in range(30)])
    monkeypatch.setattr(scoring, "VOCABULARY", frequent)
    found = by_id(scoring.score_documents(frame(spark, rows)))
    for doc, score in pair_scores(rows).items():
        assert found[doc][5] == pytest.approx(score, rel=1e-2)


def test_pair_model_sums_to_one():
    rng = np.random.default_rng(1)
    n = np.sort(rng.integers(3, 50, 40))[::-1].astype(np.int64)
    words = scoring.Words(np.arange(40, dtype=np.uint64), n, int(n.sum()) + 7, 42, 5)
    counts = {int(v): int(c) for v, c in zip(range(0, 30, 7), (3, 2, 2, 2, 2))}
    u = 0
    words.backoff[u] = np.log10(1 - sum(c - scoring.DISCOUNT for c in counts.values()) / words.context_counts[u])
    keys = np.arange(40, dtype=np.uint64) + np.uint64(u * scoring.WIDTH)
    p = 10.0 ** words.backed_off(keys)
    for v, c in counts.items():
        p[v] = 10.0 ** words.log_probability(keys[v : v + 1], np.array([float(c)]))[0]
    rest = 10.0 ** words.backoff[u] * (1 - (10.0**words.base).sum())  # the rarer words and the unseen one
    assert p.sum() + rest == pytest.approx(1.0)


@settings(max_examples=40, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 300), st.integers(0, 5000)), max_size=200))
def test_trie_finds_what_it_holds(tmp_path_factory, pairs):
    ordered = sorted(pairs)
    context, successor = (np.array([p[k] for p in ordered], np.int64) for k in (0, 1))
    value = -np.arange(len(ordered), dtype=float)
    path = tmp_path_factory.mktemp("trie") / "levels"
    path.write_bytes(elias_fano.trie(context, successor, value, 1 << 17))
    trie = elias_fano.Trie(str(path), 1 << 17)
    asked = [*ordered, *((c, s + 1) for c, s in ordered), (301, 0), (0, 0)]
    found, got = trie.find(*(np.array([p[k] for p in asked], np.int64) for k in (0, 1)))
    assert found.tolist() == [p in pairs for p in asked]
    assert np.allclose(got[: len(ordered)], value, atol=1.0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 1 << 40)), min_size=1, max_size=400), st.lists(st.integers(0, 1 << 41), max_size=50))
def test_sequence_places_and_successors(values, asked):
    values, asked = np.sort(np.array(values, np.int64)), np.array([*values, *asked, 0], np.int64)
    sequence = elias_fano.Sequence(np.frombuffer(elias_fano.encode(values), np.uint8))
    assert sequence.at(np.arange(len(values))).tolist() == values.tolist()
    assert sequence.successor(asked).tolist() == np.searchsorted(values, asked).tolist()


def test_opened_level_stays_packed():
    values = np.cumsum(np.random.default_rng(2).integers(0, 5000, 300_000))
    data = elias_fano.encode(values)
    sequence = elias_fano.Sequence(np.frombuffer(data, np.uint8))
    assert sequence.ones.nbytes + sequence.zeros.nbytes < 0.5 * len(values) and len(data) < 2.2 * len(values)
    assert (sequence.at(np.arange(0, 300_000, 7)) == values[::7]).all()


@pytest.mark.parametrize("frequent", [12, scoring.VOCABULARY])
def test_scores_do_not_depend_on_the_shards(spark, monkeypatch, frequent):
    rng = np.random.default_rng(8)
    rows = rows_of([" ".join(f"w{int(90 * x**3)}" for x in rng.random(rng.integers(0, 60))) for _ in range(80)])
    monkeypatch.setattr(scoring, "VOCABULARY", frequent)
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("1", "3", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(by_id(scoring.score_documents(frame(spark, rows))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for other in found[1:]:
        assert all(other[doc][5] == pytest.approx(v[5], rel=1e-9) for doc, v in found[0].items())


def test_encoding(docs, rows, empty):
    library = Tokenizer.from_file(BYTE_BPE)
    found = by_id(bpe.encode_documents(docs, BYTE_BPE))
    for doc, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[doc] == (len(ids), sha, hashlib.sha256((text or "").encode()).hexdigest())
    assert bpe.encode_documents(empty, BYTE_BPE).collect() == []


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.sampled_from([*"ab  \n\t'1é😀", "'s", "'ll", " the", "aaaa", "\x1c", "　", "́", "<|endoftext|>"]), max_size=12).map("".join)
    | st.text(max_size=20)
)
def test_encoding_of_any_text(text):
    ids = Tokenizer.from_file(BYTE_BPE) if not hasattr(test_encoding_of_any_text, "t") else test_encoding_of_any_text.t
    test_encoding_of_any_text.t = ids
    coder = bpe.encoder(BYTE_BPE)
    coded = coder.encode(text)
    assert np.frombuffer(coded, "<u4").tolist() == ids.encode(text, add_special_tokens=False).ids
    assert coder.decode(coded) == text


def pieces_hold(found, expected, size=4096):
    sequences, by_doc = {}, {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
    assert set(by_doc) == set(expected)
    for doc, ids in expected.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part) and r["doc_tokens"] == len(ids)
            at += r["length"]
        assert at == len(ids)
    return sequences


def test_packing(docs, rows, empty):
    library = Tokenizer.from_file(WORD_BPE)
    expected = {r[0]: [*library.encode(r[1] or "", add_special_tokens=False).ids, packing.END_ID] for r in rows}
    sequences = pieces_hold(packing.pack_documents(docs, WORD_BPE).collect(), expected)
    total = sum(map(len, expected.values()))
    assert len(sequences) <= total // 4096 + 2
    assert packing.pack_documents(empty, WORD_BPE).collect() == []


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), min_size=1, max_size=20))
def test_plan_holds_all_pieces(lengths):
    plan = packing.packing_plan(lengths, size=64, step=1)
    filled, seen = {}, dict.fromkeys(lengths, 0)
    for length, first, after, sequence, per in plan:
        assert first == seen[length] if first < after else True
        seen[length] += after - first
        for rank in range(first, after):
            s = sequence + (rank - first) // per
            filled[s] = filled.get(s, 0) + length
    assert seen == lengths
    assert max(filled.values()) <= 64
    lower = -(-sum(k * n for k, n in lengths.items()) // 64)
    longer = sum(n for k, n in lengths.items() if k > 32)
    assert len(filled) <= max(lower, longer) * 1.7 + 2


def test_quality_rules(docs, rows, empty):
    found = by_id(quality_rules.with_base_verdict(quality_rules.measures(docs)))
    for doc, text, *_ in rows:
        text = text or ""
        words = text.encode().split()
        lines = [line for line in text.split("\n") if line.encode().split()]
        n, repeats = len(words), repeat_words(text)
        expected = (
            "s", n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeats,
            n < 50 or 100 * repeats > 50 * n,
        )
        assert found[doc] == expected, text[:50]
    assert quality_rules.quality_verdicts(empty).collect() == []


def test_condemned_host(spark):
    good, bad = " ".join(f"w{i}" for i in range(80)), "short"
    rows = [(i, bad if i % 10 else good, "bad") for i in range(100)] + [(100 + i, good, "good") for i in range(100)]
    rows += [(300, bad, "tiny"), (301, good, "tiny"), (400, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    verdicts = quality_rules.quality_verdicts(docs)
    kept = {r["doc_id"] for r in verdicts.where("kept").collect()}
    assert not any(i < 100 for i in kept) and {*range(100, 200), 301, 400} <= kept and 300 not in kept
    assert {r["doc_id"] for r in quality_rules.keep_good(docs).collect()} == kept
    plan = verdicts._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
