"""Training, tuning and applying the keep/discard classifiers with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litsieve.operators.boosting import BoostedTrees
from litsieve.operators.features import TermVectorizer, with_class_weight, with_terms
from litsieve.operators.reports import class_report
from litsieve.operators.sgd import SgdClassifier
from litsieve.session import materialise

# Model settings of the published classifiers. Fixed values. The first four are
# Spark's own learners: its boosted trees have no minimum size for a node to be
# split, forests are as deep as Spark allows, since theirs had no limit, and the
# linear ones are solved by quasi-Newton steps. The last three learn as published:
# gradient descent with falling steps, and trees with both size bounds.
MODELS: dict[str, tuple[type, dict[str, Any]]] = {
    "gbt": (
        GBTClassifier,
        {"stepSize": 0.05, "maxIter": 1600, "maxDepth": 3, "minInstancesPerNode": 150,
         "featureSubsetStrategy": "0.7", "subsamplingRate": 0.85},
    ),
    "rf": (
        RandomForestClassifier,
        {"numTrees": 50, "minInstancesPerNode": 15, "maxDepth": 30},
    ),
    "logistic": (
        LogisticRegression,
        {"regParam": 0.5, "elasticNetParam": 0.0, "standardization": False},
    ),
    "svm": (LinearSVC, {"regParam": 0.0001, "standardization": False, "maxIter": 1000, "tol": 0.001}),
    "sgd_logistic": (SgdClassifier, {"loss": "log", "alpha": 0.5, "epochs": 5}),
    "sgd_svm": (SgdClassifier, {"loss": "hinge", "alpha": 0.0001, "epochs": 1000, "tol": 0.001}),
    "boosted": (
        BoostedTrees,
        {"rounds": 1600, "depth": 3, "stepSize": 0.05, "leastSplit": 600, "leastLeaf": 150, "columns": 0.7, "rows": 0.85},
    ),
}
BALANCED = {"rf", "logistic", "svm", "sgd_logistic", "sgd_svm"}
SEEDED = {"gbt", "rf", "sgd_logistic", "sgd_svm", "boosted"}


def classifier(kind: str, seed: int | None = None, **settings: Any) -> Estimator:
    if kind not in MODELS:
        raise ValueError(f"unknown model {kind!r}")
    cls, defaults = MODELS[kind]
    params = {"featuresCol": "features", "labelCol": "label", **defaults, **settings}
    if kind in BALANCED:
        params["weightCol"] = "weight"
    if seed is not None and kind in SEEDED:
        params["seed"] = seed
    if kind in ("gbt", "rf"):
        # long chains of trees: cut the lineage of the node-id cache
        params = {"cacheNodeIds": True, "checkpointInterval": 10} | params
    return cls(**params)


def _training_rows(df: DataFrame, kind: str, *keep: str) -> DataFrame:
    """Words, label and weight, stored once: every fit reads them several times."""
    rows = df.select(*keep, "words", F.col("label").cast("double").alias("label"))
    rows = materialise(rows, "training")
    return with_terms(with_class_weight(rows) if kind in BALANCED else rows)


#: Bytes of binned rows that a task of Spark's trees reads, about.
BINNED = 128 << 20


def _in_bounds(ready: DataFrame, rows: int, features: int, most: int = BINNED) -> DataFrame:
    """Vectors in partitions small enough for Spark's trees, which keep four bytes per row and feature."""
    tasks = -(-rows * features * 4 // most)
    return ready.repartition(tasks) if tasks > ready.rdd.getNumPartitions() else ready


def fit(train: DataFrame, kind: str, seed: int | None = None,
        vectorizer: Mapping[str, Any] | None = None, validation: DataFrame | None = None,
        **settings: Any) -> PipelineModel:
    """Train on rows with ``words`` (array of strings) and ``label`` (0/1).

    Only the vectors are kept for the passes of the learner, never the texts. A
    validation set chooses the number of rounds of ``boosted`` trees; its words have no
    part in the vocabulary.
    """
    if validation is not None and kind != "boosted":
        raise ValueError(f"{kind!r} has no use for a validation set")
    rows = _training_rows(train, kind)
    vectors = TermVectorizer(**(vectorizer or {})).fit(rows)
    ready = vectors.transform(rows).drop("words", "terms")
    if validation is not None:
        held = vectors.transform(_training_rows(validation, kind)).drop("words", "terms")
        ready = ready.withColumn("held", F.lit(False)).unionByName(held.withColumn("held", F.lit(True)))
        settings = {"validationCol": "held"} | settings
    if kind in ("gbt", "rf"):
        ready = _in_bounds(ready, rows.count(), len(vectors.vocabulary))
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel([vectors, classifier(kind, seed, **settings).fit(ready)])
    finally:
        ready.unpersist()


def margin(model: Model) -> Column:
    """Signed confidence: positive means the positive class."""
    if isinstance(model, RandomForestClassificationModel):
        return vector_to_array(F.col("probability"))[1] - F.lit(0.5)
    return vector_to_array(F.col("rawPrediction"))[1]


def predict(model: PipelineModel, df: DataFrame, class_names: Sequence[str] = ("discard", "keep"),
            positive: int = 1) -> DataFrame:
    """Add pred_class, confidence, abs_value and, given a label, true_class and fp_fn.

    Row-local, so it runs on a stream as well.
    """
    names = F.array(*map(F.lit, class_names))
    out = model.transform(with_terms(df)).drop("terms", "features").withColumns(
        {
            "pred_class": names[F.col("prediction").cast("int")],
            "confidence": margin(model.stages[-1]),
        }
    ).withColumn("abs_value", F.abs("confidence"))
    if "label" in df.columns:
        out = out.withColumn("true_class", names[F.col("label").cast("int")]).withColumn(
            "fp_fn",
            F.when(F.col("label") == F.col("prediction"), F.lit(""))
            .when(F.col("prediction") == positive, F.lit("FP"))
            .when(F.col("label") == positive, F.lit("FN")),
        )
    return out.drop("rawPrediction", "probability", "prediction")


def evaluate(predictions: DataFrame, split: str = "split", beta: float = 2.0,
             keep: str = "keep") -> DataFrame:
    """F-beta, precision, recall and NPV per split."""
    return class_report(predictions, split, beta, keep=keep).select(
        split, "f_beta", F.col("keep_precision").alias("p"), F.col("keep_recall").alias("r"),
        F.col("discard_precision").alias("npv"),
    )


def _terms_frame(spark: SparkSession, model: PipelineModel, values: Sequence[float],
                 column: str) -> DataFrame:
    rows = list(zip(model.stages[0].vocabulary, map(float, values)))
    return spark.createDataFrame(rows, f"term string, {column} double")


def feature_weights(spark: SparkSession, model: PipelineModel, n: int = 20) -> DataFrame:
    """The n highest and n lowest weights of a linear model."""
    weights = _terms_frame(spark, model, model.stages[-1].coefficients.toArray(), "weight")
    top = weights.orderBy(F.desc("weight"), "term").limit(n).withColumn("side", F.lit("highest"))
    low = weights.orderBy("weight", "term").limit(n).withColumn("side", F.lit("lowest"))
    return top.unionByName(low)


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Terms a tree model used, most important first."""
    importances = model.stages[-1].featureImportances.toArray()
    return (
        _terms_frame(spark, model, importances, "importance")
        .filter(F.col("importance") > 0)
        .orderBy(F.desc("importance"), "term")
    )


def f_beta_evaluator(beta: float = 2.0) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        metricName="fMeasureByLabel", metricLabel=1.0, beta=beta, labelCol="label"
    )


def _grid(stage: Estimator, options: Mapping[str, Sequence[Any]]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in options.items():
        builder = builder.addGrid(stage.getParam(name), list(values))
    return builder.build()


def _name_params(params: Mapping) -> str:
    return ", ".join(sorted(f"{p.name}={v}" for p, v in params.items()))


def _fold_scores(rows: DataFrame, fold: int, stages: Sequence[Estimator], grid: Sequence[dict],
                 evaluator: MulticlassClassificationEvaluator) -> list[float]:
    """The score of every candidate on one fold, fitted on the others.

    All of them share the vocabulary of the fold and its vectors; texts are not kept.
    """
    vectorizer, learner = stages
    sets = [rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)]
    if any(part.isEmpty() for part in sets):
        raise ValueError(f"fold {fold} leaves no rows to fit or to score")
    vectors = vectorizer.fit(sets[0])
    fitted, held = (
        vectors.transform(part).drop("words", "terms").persist(StorageLevel.MEMORY_AND_DISK) for part in sets
    )
    try:
        return [evaluator.evaluate(learner.fit(fitted, params).transform(held)) for params in grid]
    finally:
        fitted.unpersist()
        held.unpersist()


def grid_search(train: DataFrame, kind: str, options: Mapping[str, Sequence[Any]],
                validation: DataFrame | None = None, key: str = "id", folds: int = 5,
                beta: float = 2.0, seed: int = 0,
                vectorizer: Mapping[str, Any] | None = None,
                **settings: Any) -> tuple[PipelineModel, DataFrame]:
    """(best model, table of F-beta per candidate).

    Scored on the validation set if given, else by cross-validation. Folds are a
    hash of the sample ID, so they are the same on every run.
    """
    spark = train.sparkSession
    rows = _training_rows(train, kind, key).withColumn(
        "fold", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds)).cast("int")
    )
    stages = [TermVectorizer(**(vectorizer or {})), classifier(kind, seed, **settings)]
    job = Pipeline(stages=stages)
    grid = _grid(stages[-1], options)
    evaluator = f_beta_evaluator(beta)
    if validation is None:
        by_fold = [_fold_scores(rows, fold, stages, grid, evaluator) for fold in range(folds)]
        scores = [sum(of_fold) / folds for of_fold in zip(*by_fold)]
        best = job.fit(rows, grid[max(range(len(grid)), key=scores.__getitem__)])
    else:
        held_out = _training_rows(validation, kind, key)
        models = [job.fit(rows, params) for params in grid]
        scores = [evaluator.evaluate(m.transform(held_out)) for m in models]
        best = models[max(range(len(grid)), key=scores.__getitem__)]
    table = spark.createDataFrame(
        [(_name_params(p), float(s)) for p, s in zip(grid, scores)], "params string, f_beta double"
    )
    return best, table


# -- tuning runs -------------------------------------------------------------

RUN_COLUMNS = ("run_time", "metrics", "f_beta", "p", "r", "npv", "script", "split_seed", "model_seed")


def run_record(metrics: DataFrame, script: str, run_time: Column, split_seed: int,
               model_seed: int) -> DataFrame:
    """One line of the tuning index per row of :func:`evaluate`, seeds included."""
    return metrics.withColumns(
        {
            "run_time": F.date_format(run_time, "yyyy/MM/dd-HH-mm-ss"),
            "metrics": F.lit("F2PRNPV"),
            "script": F.lit(script),
            "split_seed": F.lit(split_seed),
            "model_seed": F.lit(model_seed),
        }
    ).select(*RUN_COLUMNS)


def append_run(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)


def best_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("f_beta"), "run_time").limit(n)
