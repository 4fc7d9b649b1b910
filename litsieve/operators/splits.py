"""Reproducible random splits.

Membership is a hash of (seed, sample ID), so it does not depend on how the
data is partitioned, needs no shuffle and survives a lost executor unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from litsieve.functions.clean import normalise_journal

# (key column, seed) -> uniform number in [0, 1)
Draw = Callable[[Column, int], Column]


def hash_draw(key: Column, seed: int) -> Column:
    """The first 32 bits of a digest of seed and key, which any SQL engine can repeat."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(2**32))


def with_monitored(df: DataFrame, journals: DataFrame, journal: str = "journal") -> DataFrame:
    """Add ``monitored``: is the sample's journal in the list of normalised names?"""
    listed = journals.select(
        F.col("journal").alias("_listed"), F.lit(True).alias("monitored")
    ).distinct()
    return (
        df.join(listed, normalise_journal(F.col(journal)) == F.col("_listed"), "left")
        .withColumn("monitored", F.coalesce("monitored", F.lit(False)))
        .drop("_listed")
    )


def split_random(df: DataFrame, key: str, fraction: float = 0.2, seed: int = 0,
                 journals: DataFrame | None = None, journal: str = "journal",
                 draw: Draw = hash_draw) -> DataFrame:
    """Add ``retained``; the leftover is its complement, duplicates and all.

    With ``journals`` only samples from listed journals can be retained.
    """
    retained = draw(F.col(key), seed) < F.lit(fraction)
    if journals is None:
        return df.withColumn("retained", retained)
    return (
        with_monitored(df, journals, journal)
        .withColumn("retained", F.col("monitored") & retained)
        .drop("monitored")
    )


def split_three_way(df: DataFrame, key: str, is_after: Column, test: float = 0.15,
                    validation: float = 0.235, seed: int = 0, draw: Draw = hash_draw) -> DataFrame:
    """Add ``split``: test and validation come from "after" samples only.

    The validation fraction applies to what the test draw leaves over; all other
    samples, and every "before" sample, are for training.
    """
    key_col = F.col(key)
    return df.withColumn(
        "split",
        F.when(is_after & (draw(key_col, seed) < F.lit(test)), F.lit("test"))
        .when(is_after & (draw(key_col, seed + 1) < F.lit(validation)), F.lit("val"))
        .otherwise(F.lit("train")),
    )


def small_build(df: DataFrame, key: str, subset: str, sizes: Mapping[str, int],
                default: int = 40, seed: int = 0, draw: Draw = hash_draw) -> DataFrame:
    """A fixed number of samples per subset, the lowest draws first.

    Spark applies a rank bound before the shuffle too, so each task passes on no
    more than that many rows of any subset.
    """
    order = Window.partitionBy(subset).orderBy(draw(F.col(key), seed), key)
    size = F.lit(default)
    for name, n in sizes.items():
        size = F.when(F.col(subset) == name, F.lit(n)).otherwise(size)
    largest = max([default, *sizes.values()])
    return (
        df.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= largest)
        .filter(F.col("_rank") <= size)
        .drop("_rank")
    )


def split_summary(df: DataFrame, positive: Column, journal: str = "journal") -> DataFrame:
    """Samples, positives, negatives and journals of input, retained and leftover.

    Counts are first reduced to one row per journal, which makes counting the
    distinct journals of each side a plain count.
    """
    sides = {
        "input": F.lit(True),
        "retained": F.col("retained"),
        "leftover": ~F.col("retained"),
    }
    per_journal = df.groupBy(journal).agg(
        *[F.count_if(c).alias(f"{s}_refs") for s, c in sides.items()],
        *[F.count_if(c & positive).alias(f"{s}_pos") for s, c in sides.items()],
    )
    totals = per_journal.agg(
        *[F.sum(f"{s}_refs").alias(f"{s}_refs") for s in sides],
        *[F.sum(f"{s}_pos").alias(f"{s}_pos") for s in sides],
        *[F.count_if(F.col(f"{s}_refs") > 0).alias(f"{s}_journals") for s in sides],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(s).alias("side"),
                F.coalesce(f"{s}_refs", F.lit(0)).alias("refs"),
                F.coalesce(f"{s}_pos", F.lit(0)).alias("pos"),
                F.col(f"{s}_journals").alias("journals"),
                F.coalesce("input_refs", F.lit(0)).alias("input_refs"),
            )
            for s in sides
        ]
    )
    refs, pos = F.col("refs"), F.col("pos")

    def percent(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, 100.0 * part / whole)

    return totals.select(F.inline(rows)).select(
        "side", "refs", "pos", (refs - pos).alias("neg"),
        percent(pos, refs).alias("pos_pct"), percent(refs - pos, refs).alias("neg_pct"),
        "journals", percent(refs, F.col("input_refs")).alias("input_pct"),
    )


def class_balance(df: DataFrame, positive: Column, split: str = "split") -> DataFrame:
    counts = df.groupBy(split).agg(
        F.count("*").alias("samples"),
        F.count_if(positive).alias("positive"),
    )
    return counts.select(
        split, "samples", "positive", (F.col("samples") - F.col("positive")).alias("negative"),
        (100.0 * F.col("positive") / F.col("samples")).alias("positive_pct"),
    )
