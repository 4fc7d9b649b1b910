"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One star step: neighbours of a node are linked to the least node around it.

    The large step moves the greater neighbours, the small step the lesser ones. The
    least neighbour is an aggregate that is combined before the shuffle, and a centre
    with many links is a hot join key that adaptive execution splits.
    """
    both = edges if small else edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    moved = both.join(least, "a")
    if small:
        # every row has a > b: the node itself and its lesser neighbours go to the least
        out = moved.select(F.col("b").alias("a"), F.col("root").alias("b")).union(
            moved.select("a", F.col("root").alias("b"))
        )
    else:
        out = moved.filter("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return out.filter("a != b").distinct()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(a, root): for every linked node the least node it can reach, roots left out.

    ``edges`` has two columns of numbers. Each round is checkpointed to the shared
    folder, so that plans stay short and a lost executor costs a read; rounds needed
    grow with the logarithm of the longest chain.
    """
    a, b = edges.columns
    now = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    )
    now = now.distinct().checkpoint()
    state = None
    for _ in range(most):
        now = _stars(_stars(now, small=False), small=True).checkpoint()
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if seen == state:
            return now.toDF("a", "root")
        state = seen
    raise RuntimeError(f"components did not settle in {most} rounds")
