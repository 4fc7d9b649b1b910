"""The side job: extra negative articles from an archive."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from litsieve.operators import candidates
from litsieve.sources.archive import write_by_journal


@dataclass(frozen=True)
class Backfill:
    outcomes: DataFrame  # every article found, with its outcome
    wanted: DataFrame    # the ones to keep, with or without a body
    main_files: DataFrame
    report: DataFrame
    examples: DataFrame


def backfill(articles: DataFrame, known: DataFrame, files: DataFrame,
             types: Mapping[str, bool] = candidates.ARTICLE_TYPES) -> Backfill:
    """Judge archive articles and pick the main PDF of their archives.

    ``articles``: journal, pmcid, pmid, type, has_body, text. ``files``: the
    PDFs of the archives (pmcid, pos, path, size). Articles whose archive has no
    main file count as having no PDF.
    """
    main = candidates.main_file(files, "pmcid")
    with_pdf = main.filter(F.col("path").isNotNull()).select("pmcid", F.lit(True).alias("has_pdf"))
    judged = candidates.with_outcome(articles, known, types)
    outcomes = judged.join(with_pdf, "pmcid", "left").withColumn(
        "has_pdf", F.coalesce("has_pdf", F.lit(False))
    )
    wanted = outcomes.filter(F.col("outcome") == candidates.WANTED)
    return Backfill(
        outcomes=outcomes,
        wanted=wanted,
        main_files=main,
        report=candidates.outcome_report(outcomes),
        examples=candidates.outcome_examples(outcomes),
    )


def write_texts(job: Backfill, path: str, mode: str = "errorifexists") -> None:
    """The wanted texts, below one folder per journal."""
    write_by_journal(job.wanted.select("journal", "pmcid", "pmid", "text"), path, mode)
