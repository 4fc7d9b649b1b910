"""Prediction files: a header line, then 19 ``|`` fields per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from litsieve.schema import FIELD_SEP, PREDICTION_FIELDS


def parse_predictions(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lower-cased fields of each line; a line of another width fails the job."""
    width = len(PREDICTION_FIELDS)
    parts = F.split(F.lower(F.col(value)), r"\|", -1)
    checked = F.when(F.size(parts) == width, parts).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {width} fields: "), F.col(value)))
    )
    return (
        lines.filter(F.col(value) != "")
        .select(checked.alias("p"))
        .filter(F.col("p")[0] != PREDICTION_FIELDS[0])
        .select([F.col("p")[i].alias(n) for i, n in enumerate(PREDICTION_FIELDS)])
    )


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return parse_predictions(spark.read.text(path))


def write_predictions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select(*PREDICTION_FIELDS).write.mode(mode).csv(
        path, sep=FIELD_SEP, header=True, quote="", emptyValue=""
    )


# Column order and titles of the long output. Fixed values.
LONG_OUTPUT = {
    "pubmed": "ID", "trueClass": "True Class", "predClass": "Pred Class", "fpFn": "FP/FN",
    "confidence": "Confidence", "absValue": "Abs Value", "ap": "ap", "gxd": "gxd", "go": "go",
    "tumor": "tumor", "qtl": "qtl", "journal": "journal",
}


def long_output(predictions: DataFrame) -> DataFrame:
    return predictions.select([F.col(c).alias(t) for c, t in LONG_OUTPUT.items()])
