"""Histogram trees on blocks against a plain learner, tree by tree."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from litsieve.operators import blocks, boosting, learning
from litsieve.operators.boosting import BoostedTrees, Settings, drawn

D = 15


def _rows(n=500, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.random((n, D)) < np.linspace(0.1, 0.9, D)
    score = 2.0 * x[:, 3] - 1.5 * x[:, 8] + 2.0 * (x[:, 3] & x[:, 5]) - 0.7 + rng.normal(0, 1, n)
    return x, (score > 0).astype(int)


def _frame(spark, x, y):
    rows = [(Vectors.sparse(D, np.flatnonzero(r), np.ones(r.sum())), int(v)) for r, v in zip(x, y)]
    return spark.createDataFrame(rows, ["features", "label"])


@pytest.fixture(scope="module")
def vectors(spark):
    df = _frame(spark, *_rows())
    df.cache().count()
    return df


def _dense(df, seed=0):
    """(rows, labels) in the order of their numbers."""
    parts = []
    for b in blocks.pack(df, boosting.BLOCK, seed=seed).toArrow().to_batches():
        for rows in blocks.unpack(b):
            x = np.zeros((len(rows), D), bool)
            for i in range(len(rows)):
                x[i, rows.terms[rows.starts[i] : rows.starts[i + 1]]] = True
            parts.append((rows.block, x, rows.labels))
    parts.sort(key=lambda p: p[0])
    return np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])


def _grow(x, r, h, node, depth, number, s, out):
    """Recursive plain tree over the rows given."""
    out["value"][node] = r.sum() / h.sum() if len(r) else 0.0
    if depth == s.depth or len(r) < s.least_split:
        return
    best = None
    allowed = drawn(np.arange(D), s.columns, s.seed, 1, number, node)
    for f in np.flatnonzero(allowed):
        a, b = r[x[:, f]], r[~x[:, f]]
        if min(len(a), len(b)) < max(s.least_leaf, 1):
            continue
        gain = len(a) * len(b) / len(r) * (a.mean() - b.mean()) ** 2
        if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
            best = gain, f
    if best is None:
        return
    out["feature"][node], out["gain"][node] = best[1], best[0]
    for child, rows in ((2 * node + 1, ~x[:, best[1]]), (2 * node + 2, x[:, best[1]])):
        _grow(x[rows], r[rows], h[rows], child, depth + 1, number, s, out)


def _plain(x, y, s):
    f = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    trees, margins = [], [f.copy()]
    for number in range(s.rounds):
        p = 1 / (1 + np.exp(-f))
        r, h = y - p, p * (1 - p)
        some = drawn(np.arange(len(y)), s.rows, s.seed, 2, number)
        nodes = 2 ** (s.depth + 1) - 1
        tree = {"feature": [-1] * nodes, "value": [0.0] * nodes, "gain": [0.0] * nodes}
        _grow(x[some], r[some], h[some], 0, 0, number, s, tree)
        at = np.zeros(len(y), int)
        for _ in range(s.depth):
            split = np.array(tree["feature"])[at]
            at = np.where(split < 0, at, 2 * at + 1 + x[np.arange(len(y)), split])
        f = f + s.step * np.array(tree["value"])[at]
        trees.append(tree)
        margins.append(f.copy())
    return trees, margins


SETTINGS = [
    Settings(rounds=40, depth=3, step=0.2, least_split=60, least_leaf=15, seed=4),
    Settings(rounds=5, depth=2, step=0.5, least_split=0, least_leaf=0, columns=1.0, rows=1.0, seed=1),
    Settings(rounds=4, depth=4, step=0.1, least_split=250, least_leaf=1, columns=0.5, seed=8),
    Settings(rounds=3, least_split=10_000),
]


@pytest.mark.parametrize("s", SETTINGS)
def test_equals_a_plain_learner(vectors, s):
    packed = blocks.pack(vectors, boosting.BLOCK, seed=s.seed)
    trees, start, used = boosting.fit_trees(packed, D, s)
    x, y = _dense(vectors, s.seed)
    want, _ = _plain(x, y, s)
    assert used == len(trees) == s.rounds and start == pytest.approx(np.log(y.mean() / (1 - y.mean())))
    for got, plain in zip(trees, want):
        assert list(got.feature) == plain["feature"]
        assert np.allclose(got.value, plain["value"], atol=1e-6) and np.allclose(got.gain, plain["gain"], atol=1e-5)


@pytest.mark.parametrize("s", SETTINGS[:2])
def test_one_job_grows_what_a_job_per_level_grows(vectors, monkeypatch, s):
    """The rounds between two refreshes were three jobs each, also for a few rows."""
    packed = blocks.pack(vectors, boosting.BLOCK, seed=s.seed)
    jobs, grow = [], boosting.grow
    monkeypatch.setattr(boosting, "grow", lambda *a: jobs.append(1) or grow(*a))
    whole = boosting.fit_trees(packed, D, s)
    assert not jobs
    monkeypatch.setattr(boosting, "WHOLE", 0)
    assert boosting.fit_trees(packed, D, s) == whole and len(jobs) == s.rounds


def test_size_bounds(vectors):
    s = Settings(rounds=6, depth=3, step=0.3, least_split=120, least_leaf=40, rows=1.0, columns=1.0)
    trees, _, _ = boosting.fit_trees(blocks.pack(vectors, boosting.BLOCK), D, s)
    x, _ = _dense(vectors)
    for tree in trees:
        at = np.zeros(len(x), int)
        sizes = {0: len(x)}
        for _ in range(s.depth):
            split = np.array(tree.feature)[at]
            at = np.where(split < 0, at, 2 * at + 1 + x[np.arange(len(x)), split])
            sizes |= {int(k): int((at == k).sum()) for k in np.unique(at)}
        for node, feature in enumerate(tree.feature):
            if feature >= 0:
                assert sizes[node] >= 120 and sizes[2 * node + 1] >= 40 and sizes[2 * node + 2] >= 40


def test_partitions_do_not_matter(spark, vectors, monkeypatch):
    def fit(df):
        return BoostedTrees(rounds=4, leastSplit=30, leastLeaf=5, seed=3).fit(df)

    models = [fit(vectors.repartition(n, F.rand(n))) for n in (1, 5, 13)]
    assert models[0].trees == models[1].trees == models[2].trees


def test_blocks_do_not_change_draws_by_number(vectors):
    numbers = np.arange(20_000)
    took = drawn(numbers, 0.85, 7, 2, 11)
    assert abs(took.mean() - 0.85) < 0.01
    assert (drawn(numbers[5000:6000], 0.85, 7, 2, 11) == took[5000:6000]).all()
    assert (drawn(numbers, 0.85, 7, 2, 12) != took).any()


def test_curve_equals_truncated_models(spark, vectors):
    model = BoostedTrees(rounds=12, leastSplit=30, leastLeaf=5, stepSize=0.3).fit(vectors)
    held = _frame(spark, *_rows(200, seed=77))
    curve = {r["round"]: r for r in model.curve(held).collect()}
    assert sorted(curve) == list(range(13))
    for rounds in (0, 1, 5, 12):
        scored = model.truncated(rounds).transform(held).select("label", "prediction", "rawPrediction").collect()
        y = np.array([r.label for r in scored])
        hit = np.array([r.prediction for r in scored]) > 0
        f = np.array([r.rawPrediction[1] for r in scored])
        tp, fp, fn = (hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 1)).sum()
        assert curve[rounds].f_beta == pytest.approx(5 * tp / (5 * tp + 4 * fn + fp) if tp + fn + fp else 0)
        assert curve[rounds].p == pytest.approx(tp / (tp + fp) if tp + fp else 0)
        loss = 2 * np.logaddexp(0, np.where(y == 1, -f, f)).mean()
        assert curve[rounds].deviance == pytest.approx(loss, abs=1e-7)


def test_margins_equal_the_plain_learner(spark, vectors):
    s = SETTINGS[0]
    x, y = _dense(vectors, s.seed)
    _, margins = _plain(x, y, s)
    model = BoostedTrees(rounds=40, stepSize=0.2, leastSplit=60, leastLeaf=15, seed=4).fit(vectors)
    for rounds in (0, 33, 40):
        rows = model.truncated(rounds).transform(_frame(spark, x, y)).select("rawPrediction").collect()
        assert np.allclose([r.rawPrediction[1] for r in rows], margins[rounds], atol=1e-5)


def test_validation_ends_the_fit(spark, vectors):
    """Labels without a pattern: more rounds only fit noise."""
    rng = np.random.default_rng(1)
    x, _ = _rows(400, seed=6)
    both = _frame(spark, x, rng.integers(0, 2, 400)).withColumn("held", F.monotonically_increasing_id() % 2 == 0)
    model = BoostedTrees(rounds=400, stepSize=0.5, leastSplit=2, leastLeaf=1, validationCol="held", patience=30).fit(both)
    assert len(model.trees) < 200 and model.rounds_used <= len(model.trees)
    curve = model.curve(both.filter("held")).collect()
    best = max(r.f_beta for r in curve)
    assert model.rounds_used == min(r["round"] for r in curve if r.f_beta == best)


def test_importance_and_learning(spark):
    rows = [(i, (["mice"] if i % 3 == 0 else ["clinic"]) + [f"a{i % 7}", f"b{i % 5}"], int(i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, words array<string>, label int")
    model = learning.fit(df, "boosted", seed=1, validation=df.limit(60), rounds=40, leastSplit=20, leastLeaf=5, patience=32)
    assert learning.predict(model, df).filter("fp_fn != ''").count() == 0
    top = learning.feature_importance(spark, model).first()
    assert top.term in ("mice", "clinic")
    with pytest.raises(ValueError):
        learning.fit(df, "rf", validation=df)


def test_empty_table(spark, vectors):
    model = BoostedTrees(rounds=3).fit(vectors.limit(0))
    assert model.trees == [] and model.start == 0.0


def test_published_settings():
    model = learning.classifier("boosted", 5)
    assert model.settings() == Settings(1600, 3, 0.05, 600, 150, 0.7, 0.85, 5)
