"""Near words, forms and roots against all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from litsieve.llm import spelling

WORD = st.text("abé", min_size=6, max_size=11)


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _edited(word, rng):
    i, kind = rng.randrange(len(word)), rng.randrange(3)
    new = rng.choice("abcé")
    return word[:i] + (word[i + 1 :] if kind == 0 else new + word[i + (kind == 1) :])


def _counts(words):
    return Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))


@settings(max_examples=200, deadline=None)
@given(st.lists(WORD, min_size=1, max_size=8), st.randoms())
def test_near_words_share_a_pivot(words, rng):
    words = sorted(set(words + [e for w in words if len(e := _edited(w, rng)) > 5]))
    counts = _counts(words)
    prefix = {w: spelling.prefix(w, counts) for w in words}
    pivots = {w: spelling.pivots(prefix[w]) for w in words}
    for w in words:
        (_, _, i), (_, _, j) = pivots[w]
        assert j - i >= 2 and set(pivots[w]) <= set(prefix[w])
        cheapest = min(
            a[0] + b[0] for a in prefix[w] for b in prefix[w] if b[2] - a[2] >= 2
        )
        assert sum(p[0] for p in pivots[w]) == cheapest

    def reaches(a, b):
        ends = {b[at:] for _, _, at in prefix[b]}
        begins = {b[: at + 2] for _, _, at in prefix[b]}
        return a[pivots[a][1][2] :] in ends or a[: pivots[a][0][2] + 2] in begins

    def last(word):
        return max(g[:2] for g in prefix[word])

    for a in words:
        for b in words:
            if _near(a, b) and last(a) <= last(b):
                assert reaches(a, b)


def _plain(counts, ratio=5):
    near = {a: [b for b in counts if _near(a, b)] for a in counts}
    form = {}
    for a in counts:
        best = min(near[a], key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best is not None and counts[best] >= ratio * counts[a] else None

    def root(a):
        return a if form[a] is None else root(form[a])

    return {(a, form[a], root(a), counts[a], len(near[a]), counts.get(form[a])) for a in counts}


@pytest.mark.parametrize("seed", range(4))
def test_variants(spark, seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 9))) for _ in range(40)]
    counts = {w: rng.choice([5, 5, 30, 200, 5000]) for w in stems}
    for _ in range(250):
        edit = _edited(rng.choice(list(counts)), rng)
        if len(edit) > 5:
            counts.setdefault(edit, rng.choice([5, 6, 25, 30, 900]))
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert set(map(tuple, spelling.variants(df).collect())) == _plain(counts)


def test_long_chain(spark):
    words = ["abcdef" + "x" * i for i in range(9)]
    counts = {w: 5 * 5**i for i, w in enumerate(words)}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert {r.root for r in got.collect()} == {words[-1]}


def test_no_near_words(spark):
    got = spelling.variants(spark.createDataFrame([("abcdefgh", 9), ("zzzzzzzz", 5)], "word string, n long"))
    assert {tuple(r) for r in got.collect()} == {("abcdefgh", None, "abcdefgh", 9, 0, None), ("zzzzzzzz", None, "zzzzzzzz", 5, 0, None)}


def _plain_words(rows, every):
    total = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{low}".encode())
            if h % every == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            total[low] += 1
    return {(w, n) for w, n in total.items() if len(w) >= 6 and n >= 5}


@pytest.mark.parametrize("every", [2, 199])
def test_counted_words(spark, every):
    rng = random.Random(1)
    vocabulary = ["Straße", "ÉTRANGER", "étranger", "Naïveté", "COLOUR", "colour", "short", "behaviour", "dé×jà÷vu", "x" * 5000]
    rows = [(i, " ,.1"[i % 4].join(rng.choices(vocabulary, k=40))) for i in range(60)]
    rows += [(None, "COLOUR colour " * 9), (3, None), (4, ""), (5, "1234 _ ß"), (60, rows[0][1]), (60, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = set(map(tuple, spelling.counted_words(df, every=every).collect()))
    assert got == _plain_words(rows, every) and len(got) > 5
