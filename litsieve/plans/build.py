"""Whole jobs: labelled sample sets, their preprocessing and their splits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from litsieve.operators import selection, splits, texts
from litsieve.operators.bloom import bloom_filter
from litsieve.operators.preprocess import preprocess
from litsieve.rules import PRODUCTION, Rules
from litsieve.session import materialise
from litsieve.sources.tables import Tables

AFTER = ("discard_after", "keep_after")
BEFORE = ("keep_before", "keep_tumor")
GROUP_AFTER = ("unselected_after", "selected_after")
GROUP_BEFORE = ("selected_before",)

#: Keys that Spark broadcasts by itself, at its own threshold of ten megabytes.
BROADCAST_KEYS = 500_000

DEFAULT_STEPS = ("figureTextLegCloseWords50", "removeURLsCleanStem")


def _with_text(records: DataFrame, t: Tables) -> DataFrame:
    """Records first, text last.

    The records are stored once, so the selection is not repeated to find whose
    parts to read, and their known size lets Spark filter the parts by key
    before it shuffles any text; too many to broadcast, they are put into a Bloom
    filter for the scan. The inner join drops articles without text.
    """
    records = materialise(records, "records")
    keys = records.select("refs_key").distinct()
    likely = bloom_filter(keys, "refs_key") if records.count() > BROADCAST_KEYS else None
    return records.join(texts.assemble_text(t.parts, keys=keys, likely=likely), "refs_key")


def triage_subset(t: Tables, subset: str | None, rules: Rules = PRODUCTION, base: str = "triage",
                  restrict: bool = True, limit: int = 0, max_length: int = 0) -> DataFrame:
    """Samples of one primary-triage subset."""
    # a limit counts articles with text, so it has to look at the parts first
    records = selection.subset_records(
        t, rules, subset, base, restrict, limit, require_text=limit > 0
    )
    return texts.triage_samples(_with_text(records, t), max_length)


def group_subset(t: Tables, group: str, search: str, rules: Rules = PRODUCTION,
                 restrict: bool = True, limit: int = 0, max_length: int = 0) -> DataFrame:
    """Samples of one curation-group search."""
    records = selection.group_records(
        t, rules, group, search, restrict, limit, require_text=limit > 0
    )
    return texts.group_samples(_with_text(records, t), max_length)


def training_sets(subsets: dict[str, DataFrame], after: Iterable[str] = AFTER,
                  steps: Iterable[str] = DEFAULT_STEPS, seed: int = 0) -> DataFrame:
    """Preprocessed samples of all subsets with their subset and ``split``.

    Write it with ``partitionBy("split")`` to get the three files.
    """
    union = None
    for name, df in subsets.items():
        tagged = df.withColumn("subset", F.lit(name))
        union = tagged if union is None else union.unionByName(tagged)
    is_after = F.col("subset").isin(*after)
    return preprocess(splits.split_three_way(union, "ID", is_after, seed=seed), steps)
