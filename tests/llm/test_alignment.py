"""Alignment of two tokenizers against the libraries and a plain search for common ends."""

import hashlib
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import frame, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from souk.llm import alignment
from souk.llm.bpe import byte_letters

BYTES, PIECES = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
LETTERS = byte_letters()


@pytest.fixture(scope="module")
def library():
    one = Tokenizer.from_file(BYTES)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def tokens(text):
        whole = (" " + text).encode()
        a = [(i, bytes(LETTERS[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in two.encode(text):
            piece = two.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if two.is_byte(i) else piece.replace("▁", " ").encode()))
        same = text and all(b"".join(x for _, x in side) == whole for side in (a, b))
        return (a, b) if same else ([], [])

    return tokens


def grouped(tokens):
    """Groups of ids between common ends, and the linked pairs."""
    sides = [list(zip(accumulate(len(x) for _, x in side), (i for i, _ in side))) for side in tokens]
    common = sorted({e for e, _ in sides[0]} & {e for e, _ in sides[1]})
    groups, before = [], 0
    for end in common:
        groups.append(tuple([i for e, i in side if before < e <= end] for side in sides))
        before = end
    return groups, [(a[-1], b[-1]) for a, b in groups]


def spelled(groups):
    return ";".join("|".join(",".join(map(str, ids)) for ids in group) for group in groups)


TEXTS = [
    "Plain words, joined; and re-joined.", "a  b", " lead", "trail ", "tab\tnew\nline\r\n", "x\n y", "x\n  y", "a \nb", "two  spaces  ", "\n",
    " ", "", None, "漢字 mixed 漢字漢字", "zero\x00byte", "ﬁ ligature é", "▁mark", "a▁b", "<s> and </s> <unk>", "<|endoftext|>",
    "1234567 89", "don't we'll 'S", "\xa0nbsp　wide", "tokenization internationalization", "Plain words, joined; and re-joined.", "x" * 3000,
    "word " * 2000, "<0x41> A", "\x1c \x85",
]


def expected(library, rows):
    coded = [(r, *grouped(library(r[1] or ""))) for r in rows]
    counts = Counter(pair for _, _, links in coded for pair in links)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for row, groups, links in coded:
        text = spelled(groups)
        out.append((
            row[0], sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return sorted(out, key=str)


def test_same_alignment(spark, library):
    rows = [*rows_of(TEXTS), (None, "no id", "en", "s", 1, "x", 1), (3, "same id", "en", "s", 1, "x", 1)]
    docs = frame(spark, rows).withColumnRenamed("kept", "n_a").repartition(3)
    found = alignment.align_documents(docs, BYTES, PIECES).collect()
    assert sorted(map(tuple, found), key=str) == expected(library, rows)
    by_group = alignment.groups_of(docs.where("doc_id = 0"), BYTES, PIECES).orderBy("group_no").collect()
    assert [(r["ids_a"], r["ids_b"]) for r in by_group] == grouped(library(TEXTS[0]))[0]
    assert alignment.align_documents(frame(spark, []), BYTES, PIECES).collect() == []


PARTS = [*"ab1é漢😀'.,", " ", "  ", "\n", "\t", "▁", "\x1c", "\xa0", "the", " of", "ation", "</s>", "<|endoftext|>"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=15).map("".join) | st.text(max_size=12), max_size=5))
def test_words_give_the_libraries_tokens(library, texts):
    aligned = alignment.aligner(BYTES, PIECES).align(texts)
    spelled_groups = alignment.aligner(BYTES, PIECES).spelled(aligned)
    assert [s.decode() for s in spelled_groups] == [spelled(grouped(library(t))[0]) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.sets(st.integers(1, 59)), st.sets(st.integers(1, 59))), max_size=6))
def test_divide_and_conquer_finds_all_cuts(texts):
    ends_a, ends_b, last_a, last_b, at = [], [], [], [], 0
    for size, a, b in texts:
        ends_a += [at + e for e in sorted(x for x in a if x < size)] + [at + size]
        ends_b += [at + e for e in sorted(x for x in b if x < size)] + [at + size]
        at += size
        last_a.append(len(ends_a) - 1)
        last_b.append(len(ends_b) - 1)
    a, b = np.array(ends_a, np.int64), np.array(ends_b, np.int64)
    cut_a, cut_b = alignment.shared_cuts(a, b, np.array(last_a, np.int64), np.array(last_b, np.int64))
    assert (cut_a == np.isin(a, b)).all() and (cut_b == np.isin(b, a)).all()


def test_long_text_without_cuts():
    """A stretch that the sides never cut alike costs a few rounds, not one per token."""
    a, b = np.arange(1, 2_000_001, 2), np.arange(2, 2_000_002, 2)
    a, b = np.append(a, 2_000_001), np.append(b, 2_000_001)
    cut_a, cut_b = alignment.shared_cuts(a, b, np.array([len(a) - 1]), np.array([len(b) - 1]))
    assert cut_a.sum() == cut_b.sum() == 1


def test_every_linked_pair_is_possible():
    pair = alignment.aligner(BYTES, PIECES)
    _, a, b = pair.align([t or "" for t in TEXTS]).links
    assert (pair.pairs[pair.number(a, b)] == (a << 32 | b)).all()
