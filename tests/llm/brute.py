"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, `group` long"


def rows_of(texts, lang="en", source="s"):
    """Rows with extra columns whose names the operators use themselves."""
    return [(i, t, lang, source, len(t or ""), "x", i) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def shingles(text, words=5):
    found = WORD.findall((text or "").encode())
    if len(found) >= words:
        return Counter(tuple(found[i : i + words]) for i in range(len(found) - words + 1))
    return Counter([tuple(found)]) if found else Counter()


def probability_jaccard(x, y):
    total = 0.0
    for i in set(x) & set(y):
        total += 1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in set(x) | set(y))
    return total


def classes(nodes, linked):
    """Smallest member of each node's component."""
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


def near_classes(rows, similarity=0.8):
    sets = [(r[0], shingles(r[1])) for r in rows]
    linked = [
        (a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if x and y and probability_jaccard(x, y) >= similarity
    ]
    return classes([a for a, _ in sets], linked)


def removed(rows, span=50):
    """(n_bytes, n_removed, n_spans, sha of the kept bytes) per document."""
    first = {}
    for doc, text, *_ in rows:
        data = (text or "").encode()
        for i in range(len(data) - span + 1):
            key = data[i : i + span]
            first[key] = min(first.get(key, doc), doc)
    out = {}
    for doc, text, *_ in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - span + 1):
            if first[data[i : i + span]] < doc:
                gone[i : i + span] = b"\1" * span
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def tokens(text):
    return [*WORD.findall((text or "").encode().lower()), None]


def base_scores(rows):
    counts = Counter()
    for doc, text, *_ in rows:
        if zlib.crc32(str(doc).encode()) % 5 != 1:
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for doc, text, *_ in rows:
        found = tokens(text)
        score = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in found)
        out[doc] = (zlib.crc32(str(doc).encode()) % 5 == 1, len(found), sum(counts[t] > 0 for t in found), n, score)
    return out


def pair_scores(rows, discount=0.75):
    """Scores by the pair model of all words and pairs."""
    training = [tokens(r[1]) for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 1]
    counts = Counter(t for found in training for t in found)
    pairs = Counter(p for found in training for p in zip([0, *found], found))
    contexts, kinds = Counter(), Counter()
    for (u, _), c in pairs.items():
        contexts[u] += c
        kinds[u] += 1
    n, v = sum(counts.values()), len(counts)

    def probability(u, t):
        base = (counts[t] + 0.5) / (n + 0.5 * (v + 1))
        if not contexts[u]:
            return base
        return (max(pairs[u, t] - discount, 0) + discount * kinds[u] * base) / contexts[u]

    return {r[0]: sum(math.log10(probability(*p)) for p in zip([0, *tokens(r[1])], tokens(r[1]))) for r in rows}


def repeat_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)})


def removed_texts(rows, span=50):
    """The characters that lost no byte."""
    first = {}
    for doc, text, *_ in rows:
        data = text.encode()
        for i in range(len(data) - span + 1):
            first[data[i : i + span]] = min(first.get(data[i : i + span], doc), doc)
    out = {}
    for doc, text, *_ in rows:
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - span + 1):
            if first[data[i : i + span]] < doc:
                gone[i : i + span] = b"\1" * span
        kept, at = [], 0
        for c in text:
            size = len(c.encode())
            if not any(gone[at : at + size]):
                kept.append(c)
            at += size
        out[doc] = "".join(kept)
    return out


def near_names(rows, similarity=0.8):
    """(class, kept) of each row by its own text, whatever its id: the class is its smallest id."""
    least = near_classes([(i, r[1]) for i, r in enumerate(rows)], similarity)
    same = {}
    for i, r in enumerate(rows):
        if shingles(r[1]):
            same.setdefault(r[1], []).append(i)
    least = classes(list(least), [*least.items(), *((i, found[0]) for found in same.values() for i in found)])
    members = {}
    for i, root in least.items():
        members.setdefault(root, []).append(rows[i][0])
    out = []
    for i, r in enumerate(rows):
        name = min((x for x in members[least[i]] if x is not None), default=None) if shingles(r[1]) else r[0]
        out.append((name, name is None or r[0] == name))
    return out
