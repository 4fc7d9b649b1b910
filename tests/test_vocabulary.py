"""Vocabulary, vectors and counts from batches of documents against plain counting."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from litsieve.operators import features

DOCS = "id long, words array<string>, pos boolean"


def _docs(n=300, seed=5):
    rnd = random.Random(seed)
    rows = [(i, [f"w{min(int(rnd.expovariate(0.2)), 40)}" for _ in range(rnd.randrange(12))], rnd.random() < 0.4) for i in range(n)]
    return rows + [(n, None, True), (n + 1, [], None), (n + 2, ["w1", None, "w2", "w1", "w2"], None), (n, ["w0"], False)]


def _terms(words):
    words = words or []
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:]) if a is not None and b is not None}
    return {w for w in words if w is not None} | pairs


def _expected(rows, least=0.02, most=0.75):
    df = Counter(t for _, words, _ in rows for t in _terms(words))
    return {t: n for t, n in df.items() if least * len(rows) <= n <= most * len(rows)}


@pytest.mark.parametrize("listed", [1 << 20, 3])
def test_vocabulary_vectors_and_counts(spark, monkeypatch, listed):
    """Both ways: words that tasks know, and more of them than that, joined."""
    monkeypatch.setattr(features, "LISTED", listed)
    rows = _docs()
    df, vocab = spark.createDataFrame(rows, DOCS).repartition(5), _expected(rows)
    assert {r.term: r.df for r in features.vocabulary(df).collect()} == vocab
    got = Counter((r.id, r.term) for r in features.term_vectors(df, "id").collect())
    assert got == Counter((i, t) for i, words, _ in rows for t in _terms(words) if t in vocab)
    counts = {r.term: tuple(r)[1:] for r in features.feature_counts(df, F.col("pos")).collect()}
    assert counts == {
        t: (n, *(sum(t in _terms(w) for _, w, p in rows if p is flag) for flag in (True, False)))
        for t, n in vocab.items()
    }


def test_pairs_are_counted_before_their_shuffle(spark):
    """One row per batch and pair is shuffled, where one per document and pair was."""
    df = spark.createDataFrame([(["aa", "bb", "cc"],)] * 500, "words array<string>").coalesce(1)
    assert "MapInArrow" in features.vocabulary(df)._jdf.queryExecution().executedPlan().toString()
    assert len(list(features._listed_pairs(df, ["aa", "bb", "cc"]).collect())) == 2
