"""Licence scans against plain versions."""

import random
import re

from brute import frame, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from souk.llm import licenses


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(text):
    words, places = words_of(text), []
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


sequence = st.lists(st.integers(0, 2), min_size=1, max_size=9)


@settings(max_examples=150, deadline=None)
@given(st.lists(sequence, min_size=1, max_size=4), st.lists(st.integers(0, 3), max_size=25))
def test_matching_statistics(templates, text):
    """Longest run that ends at each word, and the longest for every place of every template."""
    automaton = licenses.Automaton(templates)
    for i, (state, length) in enumerate(automaton.statistics(text)):
        wanted = {}
        for number, template in enumerate(templates):
            for place in range(len(template)):
                size = 0
                while size <= min(place, i) and template[place - size] == text[i - size]:
                    size += 1
                if size:
                    wanted[number, place] = size
        found, at = {}, state
        while at > 0:
            for end in automaton.states[at].ends:
                found.setdefault(end, min(length, automaton.states[at].length))
            at = automaton.states[at].link
        assert found == wanted and length == max(wanted.values(), default=0)


def chains(runs):
    """The best chain by trying all of them."""
    best = 0
    for mask in range(1, 1 << len(runs)):
        chosen = sorted(r for i, r in enumerate(runs) if mask >> i & 1)
        total, before = 0, None
        for start, stop, there in chosen:
            size = stop - start
            gain = size
            if before:
                overlap = max(0, before[0] - start, before[1] - there)
                gain = size - overlap
                if gain <= 0 or start - before[0] > licenses.GAP or there - before[1] > licenses.GAP:
                    break
            total += gain
            before = (stop, there + size)
        else:
            best = max(best, total)
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(3, 9), st.integers(0, 60)), min_size=1, max_size=7, unique=True))
def test_best_chain(drawn):
    runs = [(start, start + size, there) for start, size, there in drawn]
    assert licenses.best_chain(runs) == chains(runs)


def test_scan(spark):
    rng = random.Random(4)
    parts = [*(p for p, _ in licenses.PHRASES), "mit", "licensed", "under the", "CC BY-NC 4.0", "Apache License,\nVersion", "gnu", "x", "é", "\n"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(150)]
    texts += [None, "", "!!", "MIT-License", "mitlicense", "the MIT License the mit license"]
    notices = {label: text for label, text in licenses.TEMPLATES}
    texts += list(notices.values())
    whole = len(texts) - len(notices)
    cut = notices["bsd"].split()
    texts += ["lead " + " ".join(cut[:20] + ["changed"] + cut[22:]), " ".join(cut[: len(cut) // 2]), "word " * 100_000 + notices["isc"]]
    rows = [*rows_of(texts), (None, "cc by", "en", "s", 1, "x", 1), (0, "cc by", "en", "s", 1, "x", 1)]
    docs = frame(spark, rows).withColumnRenamed("kept", "labels").withColumnRenamed("group", "score").repartition(3)
    found = licenses.scan_licenses(docs).collect()
    assert len(found) == len(rows)
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted((tuple(r[n] for n in names) for r in found), key=str) == sorted(((r[0], *base(r[1])) for r in rows), key=str)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"]}
    for i, label in enumerate(notices, whole):
        assert label in by_id[i]["labels"].split(",") and by_id[i]["score"] == 1
    changed, half, late = (by_id[len(texts) - k] for k in (3, 2, 1))
    assert changed["labels"] == "bsd" and 0.9 < changed["score"] < 1
    assert half["labels"] == "" and 0.4 < half["score"] < 0.6
    assert late["labels"] == "isc" and late["score"] == 1
    assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1 for r in found)
    spans = {(r["doc_id"], r["label"]) for r in licenses.covered_spans(docs).where("coverage = 1").collect()}
    assert {(i, label) for i, label in enumerate(notices, whole)} <= spans
    assert licenses.scan_licenses(frame(spark, [])).collect() == []
