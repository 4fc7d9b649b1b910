"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from litsieve.llm import (
    decontam,
    exact_dedup,
    html_extract,
    license_scan,
    manifest,
    mixing,
    pii,
    quality,
    queries_sql,
    secret_scan,
    simhash,
    spelling,
    substring_dedup,
    toxicity,
)
from litsieve.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scanned(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scanned(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents")).drop("kept")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audited(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_main_text, op2_toxicity, op3_pii, op4_mixing, op5_secrets, op6_quality, op7_repeats, op8_licenses,
        op9_simhash, op10_decontamination, op11_spelling, op12_exact_dedup, op13_manifest,
    )
}

#: SQL for those that SQL can express; trees, components, models and transducers have none
#: and are held against plain models in the tests.
ORACLES: dict[str, str] = {
    "op4_mixing": queries_sql.MIX,
    "op11_spelling": queries_sql.SPELLING,
    "op12_exact_dedup": queries_sql.EXACT,
    "op13_manifest": queries_sql.MANIFEST,
}
