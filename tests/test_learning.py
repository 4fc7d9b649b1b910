"""Features and classifiers on a small two-topic corpus."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from litsieve.operators import features, learning, reports
from litsieve.operators.boosting import Settings
from litsieve.plans.catalog import learning as catalog, registry
from litsieve.plans.catalog.views import Inputs


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(3)
    common = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(300):
        label = int(i % 3 == 0)
        topic = ["knock_out", "mice", "genotyp"] if label else ["patient", "clinic", "treatment"]
        words = [rnd.choice(common) for _ in range(30)] + [rnd.choice(topic) for _ in range(4)]
        if rnd.random() < 0.05:
            words += ["mice", "patient"]
        rnd.shuffle(words)
        rows.append((i, " ".join(words), label, "val" if i % 5 == 0 else "train"))
    df = spark.createDataFrame(rows, "id int, text string, label int, split string")
    return features.with_words(df).select("id", "words", "label", "split").cache()


SETTINGS = {
    "gbt": {"maxIter": 10, "minInstancesPerNode": 3, "stepSize": 0.3},
    "rf": {"numTrees": 15, "minInstancesPerNode": 2, "maxDepth": 8},
    "logistic": {"maxIter": 30},
    "svm": {"maxIter": 8},
}


@pytest.mark.parametrize("kind", list(SETTINGS))
def test_models_learn(spark, corpus, kind):
    model = learning.fit(corpus.filter("split = 'train'"), kind, seed=1, **SETTINGS[kind])
    scored = learning.predict(model, corpus).cache()
    assert {"pred_class", "confidence", "abs_value", "true_class", "fp_fn"} <= set(scored.columns)
    agree = (F.col("confidence") > 0) == (F.col("pred_class") == "keep")
    assert scored.filter(~agree).count() == 0
    metrics = {r.split: r for r in learning.evaluate(scored).collect()}
    assert metrics["val"].f_beta > 0.85
    vocab = model.stages[0].vocabulary
    assert vocab == sorted(vocab) and "mice" in vocab


def test_weights_and_importance(spark, corpus):
    model = learning.fit(corpus, "logistic", **SETTINGS["logistic"])
    rows = learning.feature_weights(spark, model, 5).collect()
    top = [r.term for r in rows if r.side == "highest"]
    assert set(top) & {"knock_out", "mice", "genotyp"}
    forest = learning.fit(corpus, "rf", seed=1, **SETTINGS["rf"])
    ranked = learning.feature_importance(spark, forest).collect()
    assert ranked[0].importance == max(r.importance for r in ranked)


def test_grid_search(spark, corpus):
    train, held = corpus.filter("split = 'train'"), corpus.filter("split = 'val'")
    grid = {"regParam": [0.5, 0.01]}
    _, by_folds = learning.grid_search(train, "logistic", grid, folds=3, **SETTINGS["logistic"])
    best, by_set = learning.grid_search(train, "logistic", grid, held, **SETTINGS["logistic"])
    assert by_folds.count() == by_set.count() == 2
    top = max(by_set.collect(), key=lambda r: r.f_beta)
    assert f"regParam={best.stages[-1].getRegParam()}" in top.params


def test_runs(spark, corpus, tmp_path):
    scores = spark.createDataFrame([("val", 0.8, 0.7, 0.9, 0.6), ("val", 0.9, 0.8, 0.9, 0.7)],
                                   "split string, f_beta double, p double, r double, npv double")
    path = str(tmp_path / "runs")
    for script in ("GB.py", "RF.py"):
        learning.append_run(learning.run_record(scores, script, F.current_timestamp(), 1, 2), path)
    runs = learning.best_runs(spark.read.parquet(path), 2).collect()
    assert [r.f_beta for r in runs] == [0.9, 0.9] and runs[0].split_seed == 1


def test_published_settings():
    params = learning.MODELS["gbt"][1]
    assert (params["maxIter"], params["stepSize"], params["maxDepth"]) == (1600, 0.05, 3)
    with pytest.raises(ValueError):
        learning.classifier("other")


def test_published_scores(spark):
    """Counts of a logged run give its logged F2, P, R and NPV."""
    cells = [("keep", "keep", 4750), ("keep", "discard", 846), ("discard", "keep", 1165),
             ("discard", "discard", 6298)]
    df = spark.createDataFrame(cells, "true_class string, pred_class string, n int").select(
        F.lit("val").alias("split"), "true_class", "pred_class",
        F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"),
    )
    row = learning.evaluate(df).first()
    assert [round(v, 4) for v in row[1:]] == [0.8393, 0.8030, 0.8488, 0.8816]
    support = reports.class_report(df).first()
    assert (support.keep_support, support.discard_support) == (5596, 7463)


def test_vocabulary_by_brute_force(corpus):
    """Dropping pairs of rare words loses no term."""
    rows = corpus.collect()
    for least, most in ((0.02, 0.75), (0.3, 0.9), (0.0, 1.0)):
        counts = {}
        for r in rows:
            terms = set(r.words) | {f"{a} {b}" for a, b in zip(r.words, r.words[1:])}
            for t in terms:
                counts[t] = counts.get(t, 0) + 1
        want = {t: n for t, n in counts.items() if least * len(rows) <= n <= most * len(rows)}
        got = {r.term: r.df for r in features.vocabulary(corpus, least, most).collect()}
        assert got == want


def test_vectorizer_refuses_a_large_vocabulary(corpus):
    with pytest.raises(ValueError):
        features.TermVectorizer(limit=3).fit(corpus)


def test_probe_by_brute_force(spark):
    terms = sorted({f"{a}{b}{i}" for a in "abc" for b in "xy" for i in range(7)})
    df = spark.createDataFrame([(t,) for t in terms], "term string")
    got = {}
    for r in reports.alphabetical_probe(df).orderBy("pos").collect():
        got.setdefault(r.part, []).append(r.term)
    mid = len(terms) // 2
    assert got == {"first": terms[:10], "middle": terms[mid - 5: mid + 5], "last": terms[-10:]}


def test_word_list(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\n of \n\n")
    assert features.read_word_list(spark, str(tmp_path / "stop.txt")) == ["the", "of"]
    with pytest.raises(ValueError):
        features.read_word_list(spark, str(tmp_path / "stop.txt"), limit=1)


def test_rows_of_trees_are_dealt_out_by_their_binned_size(spark):
    """Partitions as the files had them let what a task of the trees reads grow with the table."""
    rows = spark.range(0, 1000, 1, 2)
    assert learning._in_bounds(rows, 1000, 100, most=40_000).rdd.getNumPartitions() == 10
    assert learning._in_bounds(rows, 1000, 100) is rows


def test_candidates_of_a_fold_share_its_vocabulary(spark, monkeypatch):
    """Every candidate of every fold had counted the words anew."""
    rnd = random.Random(2)
    rows = [(i, [f"w{rnd.randrange(8)}" for _ in range(6)], rnd.randrange(2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, words array<string>, label int").coalesce(1)
    fits, fit = [], features.TermVectorizer._fit
    monkeypatch.setattr(features.TermVectorizer, "_fit", lambda self, data: fits.append(1) or fit(self, data))
    options = {"regParam": [0.5, 0.05]}
    _, table = learning.grid_search(df, "logistic", options, folds=2, maxIter=2)
    assert len(fits) == 2 + 1 and table.count() == 2


class _Made(Exception):
    pass


def _made(spark, folder, monkeypatch, name):
    """The learner that a query fits."""
    made, classifier = [], learning.classifier

    def keep(*args, **settings):
        made.append(classifier(*args, **settings))
        raise _Made

    monkeypatch.setattr(learning, "classifier", keep)
    with pytest.raises(_Made):
        registry.load()[name].run(Inputs(spark, folder))
    return made[0]


@pytest.mark.parametrize("name", ["train_boosted", "validation_curve"])
def test_boosted_trees_are_grown_as_published(spark, folder, monkeypatch, name):
    """Of 1,600 rounds 16 were grown."""
    trees = _made(spark, folder, monkeypatch, name)
    assert trees.settings() == Settings(1600, 3, 0.05, 600, 150, 0.7, 0.85, 11)
    assert trees.getOrDefault("validationCol") == "held" and trees.getOrDefault("patience") >= 1600


def test_sparks_boosted_trees_are_grown_as_published(spark, folder, monkeypatch):
    """Of 1,600 rounds 8 were grown, with smaller leaves and greater steps."""
    trees = _made(spark, folder, monkeypatch, "train_gbt")
    assert (trees.getMaxIter(), trees.getStepSize(), trees.getMaxDepth()) == (1600, 0.05, 3)
    assert (trees.getMinInstancesPerNode(), trees.getFeatureSubsetStrategy()) == (150, "0.7")
    assert trees.getSubsamplingRate() == 0.85


def test_article_rows_are_stored_without_their_texts(spark, folder):
    """The selection was repeated for the predictions."""
    rows = catalog._article_rows(Inputs(spark, folder))
    assert "words" in rows.columns and not {"title", "abstract", "extractedText"} & set(rows.columns)
    assert all("/articles-" in f for f in rows.inputFiles())
