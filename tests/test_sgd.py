"""Gradient descent on blocks against a plain loop."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from litsieve.operators import blocks, learning
from litsieve.operators.sgd import SgdClassifier, first_step

D = 12


def _rows(n=400, seed=5):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        label = int(rng.random() < 0.3)
        there = rng.random(D) < np.where(np.arange(D) < 4, 0.2 + 0.5 * label, 0.3)
        out.append((Vectors.sparse(D, np.flatnonzero(there), np.ones(there.sum())), label, [0.7, 1.6][label]))
    return out + out[:30]  # repeated rows


@pytest.fixture(scope="module")
def vectors(spark):
    df = spark.createDataFrame(_rows(), ["features", "label", "weight"])
    df.cache().count()
    return df


def _stored(df, size, seed):
    """(block, dense rows, labels, weights) as they were packed."""
    out = []
    for b in blocks.pack(df, size, weight="weight", seed=seed).toArrow().to_batches():
        for rows in blocks.unpack(b):
            dense = np.zeros((len(rows), D))
            for i in range(len(rows)):
                dense[i, rows.terms[rows.starts[i] : rows.starts[i + 1]]] = 1
            out.append((rows.block, dense, rows.labels, rows.weights))
    return sorted(out, key=lambda x: x[0])


def _plain(data, loss, alpha, epochs, seed):
    """Dense steps one after the other; blocks are averaged after each epoch."""
    total = sum(len(y) for _, _, y, _ in data)
    w, b = np.zeros(D), 0.0
    start = first_step(alpha, loss)
    for epoch in range(epochs):
        parts = []
        for block, x, y, c in data:
            ww, bb, t = w.copy(), b, epoch * len(y) + 1
            for i in np.random.default_rng([seed, epoch, block]).permutation(len(y)):
                sign = 1 if y[i] else -1
                eta = 1 / (alpha * (start + t - 1))
                z = sign * (ww @ x[i] + bb)
                slope = 1 / (1 + math.exp(z)) if loss == "log" else float(z <= 1)
                ww = ww * (1 - eta * alpha) + eta * slope * sign * c[i] * x[i]
                bb += eta * slope * sign * c[i] * 0.01
                t += 1
            parts.append((len(y) / total, ww, bb))
        w = sum(s * x for s, x, _ in parts)
        b = sum(s * x for s, _, x in parts)
    return w, b


@pytest.mark.parametrize("loss,alpha", [("log", 0.5), ("log", 0.001), ("hinge", 0.01)])
@pytest.mark.parametrize("size", [1 << 16, 100])
def test_equals_a_plain_loop(vectors, loss, alpha, size):
    model = SgdClassifier(weightCol="weight", loss=loss, alpha=alpha, epochs=3, seed=9, block=size).fit(vectors)
    w, b = _plain(_stored(vectors, size, 9), loss, alpha, 3, 9)
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-8) and abs(model.intercept - b) < 1e-8


def test_first_step():
    # alpha .5 of the published run: a typical weight of 2 ** .25, slope below one
    assert first_step(0.5, "log") == pytest.approx(2 / 2**0.25)


@pytest.mark.parametrize("size", [1 << 16, 64])
def test_partitions_and_reruns_do_not_matter(spark, vectors, size):
    def fit(df):
        return SgdClassifier(weightCol="weight", loss="log", alpha=0.01, epochs=2, seed=3, block=size).fit(df)

    models = [fit(vectors.repartition(n, F.rand(n))) for n in (1, 3, 11)] + [fit(vectors)]
    assert len({(m.coefficients, m.intercept) for m in models}) == 1


def test_tolerance_ends_early(vectors):
    model = SgdClassifier(loss="hinge", alpha=0.01, epochs=200, tol=0.01).fit(vectors)
    assert 6 <= len(model.losses) < 60 and model.losses[-1] < model.losses[0]


def test_seed_matters(vectors):
    a, b = (SgdClassifier(loss="log", alpha=0.01, epochs=1, seed=s).fit(vectors) for s in (1, 2))
    assert a.coefficients != b.coefficients


def test_margin_and_dense_vectors(spark, vectors):
    model = SgdClassifier(weightCol="weight", loss="log", alpha=0.001, epochs=5).fit(vectors)
    scored = model.transform(vectors).collect()
    for r in scored[:50]:
        margin = model.coefficients.dot(r.features.toArray()) + model.intercept
        assert r.rawPrediction[1] == pytest.approx(margin) and r.prediction == float(margin > 0)
    hits = sum(r.prediction == r.label for r in scored) / len(scored)
    assert hits > 0.75
    dense = spark.createDataFrame([(Vectors.dense([1.0] * 4 + [0.0] * 8),), (Vectors.sparse(D, [], []),)], ["features"])
    one, none = model.transform(dense).collect()
    assert one.rawPrediction[1] == pytest.approx(model.coefficients.toArray()[:4].sum() + model.intercept)
    assert none.rawPrediction[1] == pytest.approx(model.intercept)


def test_empty_table(spark, vectors):
    model = SgdClassifier(epochs=2).fit(vectors.limit(0))
    assert model.intercept == 0.0 and len(model.coefficients) == 0


def test_unknown_loss(vectors):
    with pytest.raises(ValueError):
        SgdClassifier(loss="other").fit(vectors)


def test_published_settings():
    log, hinge = learning.classifier("sgd_logistic", 7), learning.classifier("sgd_svm")
    assert (log.getOrDefault("alpha"), log.getOrDefault("epochs"), log.getSeed(), log.getWeightCol()) == (0.5, 5, 7, "weight")
    assert (hinge.getOrDefault("epochs"), hinge.getOrDefault("tol")) == (1000, 0.001)


def test_in_a_pipeline_and_a_search(spark):
    rows = [(i, ["mice", "knock", "a%d" % (i % 7)] if i % 3 == 0 else ["clinic", "patient", "a%d" % (i % 7)], int(i % 3 == 0))
            for i in range(240)]
    df = spark.createDataFrame(rows, "id int, words array<string>, label int")
    model = learning.fit(df, "sgd_logistic", seed=2)
    assert learning.predict(model, df).filter("fp_fn != ''").count() == 0
    top = [r.term for r in learning.feature_weights(spark, model, 3).collect() if r.side == "highest"]
    assert "mice" in top and "knock" in top
    best, table = learning.grid_search(df, "sgd_logistic", {"alpha": [0.5, 0.001]}, folds=2, epochs=2)
    assert table.count() == 2 and max(r.f_beta for r in table.collect()) == 1.0
