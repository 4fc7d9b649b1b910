"""Features, classifiers and tuning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from litsieve.operators import features, learning, reports
from litsieve.operators.preprocess import TEXT_FIELDS
from litsieve.plans import build, learn
from litsieve.plans.catalog.registry import query
from litsieve.plans.catalog.views import RULES, Inputs
from litsieve.session import materialise, scratch_path

_STOPS = ", ".join(f"'{w}'" for w in features.STOP_WORDS)
_CTES = {
    "toks": r"SELECT doc_id, quality, regexp_extract_all(text, '\b\w\w+\b') AS tokens FROM clean",
    "words": f"SELECT doc_id, quality, list_filter(tokens, lambda w: w NOT IN ({_STOPS})) AS ws FROM toks",
    "grams": """SELECT doc_id, quality, list_concat(ws, list_transform(range(1, len(ws)),
        lambda i: ws[i] || ' ' || ws[i + 1])) AS terms FROM words""",
    "rows": "SELECT doc_id, quality, unnest(list_distinct(terms)) AS term FROM grams",
    "vocab": """SELECT term, count(*) AS df FROM rows GROUP BY term
        HAVING count(*) BETWEEN 0.02 * (SELECT count(*) FROM documents) AND 0.75 * (SELECT count(*) FROM documents)""",
}


def _words(x: Inputs) -> DataFrame:
    return features.with_words(x.view("clean"))


@query("feature_tokens", "SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM toks", _CTES)
def _(x: Inputs):
    return x.view("clean").select(
        "doc_id", F.array_join(features.tokens(F.col("text")), " ").alias("tokens")
    )


@query("stopword_filter", "SELECT doc_id, array_to_string(ws, ' ') AS words FROM words", _CTES)
def _(x: Inputs):
    words = features.without_stop_words(features.tokens(F.col("text")))
    return x.view("clean").select("doc_id", F.array_join(words, " ").alias("words"))


@query("ngrams", "SELECT doc_id, array_to_string(terms, chr(10)) AS terms FROM grams", _CTES)
def _(x: Inputs):
    return features.with_terms(_words(x)).select(
        "doc_id", F.array_join("terms", "\n").alias("terms")
    )


@query("vocab_df", "SELECT term, df FROM vocab", _CTES)
def _(x: Inputs):
    return features.vocabulary(_words(x))


@query("binary_vectors", "SELECT r.doc_id, r.term FROM rows r JOIN vocab v ON r.term = v.term", _CTES)
def _(x: Inputs):
    return features.term_vectors(_words(x), "doc_id")


@query("feature_doc_counts", """
    SELECT r.term, count(*) AS n_docs, count(*) FILTER (coalesce(quality, 0) = 1) AS n_pos,
      count(*) FILTER (coalesce(quality, 0) <> 1) AS n_neg
    FROM rows r JOIN vocab v ON r.term = v.term GROUP BY r.term""", _CTES)
def _(x: Inputs):
    return features.feature_counts(_words(x), F.coalesce("quality", F.lit(0)) == 1)


@query("vocab_probe", """
    SELECT part, pos, term FROM
      (SELECT row_number() OVER (ORDER BY term) AS pos, count(*) OVER () AS n, term FROM vocab) v
      JOIN (SELECT unnest(['first', 'middle', 'last']) AS part) p
        ON CASE part WHEN 'first' THEN pos <= 10 WHEN 'last' THEN pos > n - 10
           ELSE pos > n // 2 - 5 AND pos <= n // 2 + 5 END""", _CTES)
def _(x: Inputs):
    return reports.alphabetical_probe(features.vocabulary(_words(x)))


@query("class_weights", """
    SELECT doc_id, quality AS label, round((SELECT count(*) FROM labels)
      / (2.0 * (SELECT count(*) FROM labels l WHERE l.quality = k.quality)), 6) AS weight FROM labels k""")
def _(x: Inputs):
    labels = x.table("labels").select("doc_id", F.col("quality").alias("label"))
    return features.with_class_weight(labels).withColumn("weight", F.round("weight", 6))


# -- classifiers at their published settings


def _labelled(x: Inputs) -> DataFrame:
    docs = x.view("clean").filter(F.col("quality").isNotNull())
    split = F.when(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0, "val").otherwise("train")
    return features.with_words(docs).select(
        F.col("doc_id").alias("id"), "words", F.col("quality").alias("label"), split.alias("split")
    )


def _stored(x: Inputs) -> DataFrame:
    """The labelled rows for a fit and what follows it: texts are cut into words once."""
    return materialise(_labelled(x), "labelled")


def _fit(x: Inputs, kind: str):
    rows = _stored(x)
    model = learning.fit(rows.filter("split = 'train'"), kind, seed=11)
    return model, rows


def _train_query(name: str, kind: str) -> None:
    def run(x: Inputs):
        model, rows = _fit(x, kind)
        return learning.evaluate(learning.predict(model, rows))

    query(name)(run)


for _name, _kind in (("train_gbt", "gbt"), ("train_rf", "rf"), ("train_logistic", "logistic"),
                     ("train_linear_svm", "svm"), ("train_sgd_logistic", "sgd_logistic"),
                     ("train_sgd_svm", "sgd_svm")):
    _train_query(_name, _kind)


def _boosted(x: Inputs):
    """All published rounds of boosted trees; the validation rows choose how many count, not how many are grown."""
    rows = _stored(x)
    train, held = (rows.filter(F.col("split") == name) for name in ("train", "val"))
    rounds = learning.MODELS["boosted"][1]["rounds"]
    return learning.fit(train, "boosted", seed=11, validation=held, patience=rounds), rows


@query("train_boosted")
def _(x: Inputs):
    model, rows = _boosted(x)
    return learning.evaluate(learning.predict(model, rows))


@query("validation_curve")
def _(x: Inputs):
    """Scores of every number of rounds, all in one pass over the validation rows."""
    model, rows = _boosted(x)
    vectors, trees = model.stages
    held = features.with_terms(rows.filter("split = 'val'")).withColumn("label", F.col("label").cast("double"))
    return trees.curve(vectors.transform(held))


@query("predict")
def _(x: Inputs):
    model, rows = _fit(x, "logistic")
    return learning.predict(model, rows).drop("words")


@query("feature_weights")
def _(x: Inputs):
    model, _ = _fit(x, "logistic")
    return learning.feature_weights(x.spark, model)


@query("feature_importance")
def _(x: Inputs):
    model, _ = _fit(x, "rf")
    return learning.feature_importance(x.spark, model)


@query("grid_search")
def _(x: Inputs):
    rows = _labelled(x)
    _, table = learning.grid_search(
        rows.filter("split = 'train'"), "logistic", {"regParam": [0.5, 0.05]}
    )
    return table


def _article_rows(x: Inputs) -> DataFrame:
    """Training rows of the articles themselves: their records and text parts.

    Stored with their words for the fit and the predictions; neither needs the texts again.
    """
    rows = learn.training_rows(build.triage_subset(x.tables(), None, RULES, restrict=False))
    return materialise(rows.drop(*TEXT_FIELDS), "articles")


def _tuned(x: Inputs) -> learn.TuningRun:
    return learn.tune(
        _article_rows(x), "logistic", {"regParam": [0.5]}, "logistic.py", split_seed=3, model_seed=11
    )


@query("tuning_report")
def _(x: Inputs):
    """Selection, text, features, search and report in one go, no validation set given."""
    run = _tuned(x)
    return run.report.join(run.sizes, "split")


@query("prediction_file")
def _(x: Inputs):
    """Predictions of a model over all articles, as prediction-file records."""
    rows = _article_rows(x)
    model = learning.fit(rows, "logistic")
    return learn.prediction_records(learning.predict(model, rows))


@query("run_index")
def _(x: Inputs):
    """Two tuning runs appended to an index, best first."""
    path = scratch_path(x.spark, "runs")
    rows = _labelled(x)
    for kind in ("sgd_logistic", "sgd_svm"):
        model = learning.fit(rows.filter("split = 'train'"), kind)
        metrics = learning.evaluate(learning.predict(model, rows.filter("split = 'val'")))
        record = learning.run_record(metrics, f"{kind}.py", F.current_timestamp(), 3, 11)
        learning.append_run(record, path)
    return learning.best_runs(x.spark.read.parquet(path))
