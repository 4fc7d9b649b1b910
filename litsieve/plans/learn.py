"""The tuning job: search, refit, score every set, report, record the run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from litsieve.operators import features, learning, reports, splits
from litsieve.operators.preprocess import document, with_lengths
from litsieve.schema import PREDICTION_FIELDS, PRIM_TRIAGE, SampleType
from litsieve.session import materialise

VALIDATION_SPLIT = 0.20

_RECORD_NAMES = {
    "pubmed": "ID", "predClass": "pred_class", "confidence": "confidence", "absValue": "abs_value",
    "trueClass": "true_class", "fpFn": "fp_fn", "ap": "apStatus", "gxd": "gxdStatus",
    "go": "goStatus", "tumor": "tumorStatus", "qtl": "qtlStatus",
}


def training_rows(samples: DataFrame, kind: SampleType = PRIM_TRIAGE,
                  stop_words: Sequence[str] = features.STOP_WORDS) -> DataFrame:
    """Preprocessed samples with ``words``, ``label`` and their text lengths."""
    rows = with_lengths(samples).withColumn("document", document(samples))
    rows = rows.withColumn("label", kind.is_positive().cast("int"))
    return features.with_words(rows, "document", stop_words).drop("document")


def prediction_records(scored: DataFrame) -> DataFrame:
    """Scored samples -> the columns of a prediction file."""
    return scored.select([F.col(_RECORD_NAMES.get(f, f)).alias(f) for f in PREDICTION_FIELDS])


@dataclass(frozen=True)
class TuningRun:
    model: PipelineModel
    candidates: DataFrame   # F-beta of every parameter choice
    predictions: DataFrame  # all samples, scored, with their split
    report: DataFrame       # class report per split
    sizes: DataFrame        # samples and classes per split
    record: DataFrame       # lines for the index of runs


def tune(train: DataFrame, kind: str, options: Mapping[str, Sequence[Any]], script: str,
         validation: DataFrame | None = None, test: DataFrame | None = None, key: str = "ID",
         split_seed: int = 0, model_seed: int = 0, folds: int = 5, beta: float = 2.0,
         validation_split: float = VALIDATION_SPLIT, class_names: Sequence[str] = ("discard", "keep"),
         vectorizer: Mapping[str, Any] | None = None, **settings: Any) -> TuningRun:
    """Tune on the training rows; a missing validation set is split off them."""
    if validation is None:
        drawn = splits.split_random(train, key, validation_split, split_seed)
        validation = drawn.filter("retained").drop("retained")
        train = drawn.filter("NOT retained").drop("retained")
    model, candidates = learning.grid_search(
        train, kind, options, key=key, folds=folds, beta=beta, seed=split_seed,
        vectorizer=vectorizer, **settings,
    )
    sets = {"train": train, "val": validation} | ({"test": test} if test is not None else {})
    tagged = [df.withColumn("split", F.lit(name)) for name, df in sets.items()]
    rows = tagged[0]
    for df in tagged[1:]:
        rows = rows.unionByName(df)
    scored = learning.predict(model, rows, class_names).drop("words")
    scored = materialise(scored, "predictions")
    metrics = learning.evaluate(scored, beta=beta, keep=class_names[1])
    return TuningRun(
        model=model,
        candidates=candidates,
        predictions=scored,
        report=reports.class_report(scored, beta=beta, keep=class_names[1]),
        sizes=splits.class_balance(scored, F.col("label") == 1),
        record=learning.run_record(
            metrics.filter(F.col("split") == "val"), script, F.current_timestamp(),
            split_seed, model_seed,
        ),
    )
