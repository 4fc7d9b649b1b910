"""Running aggregates by a prefix scan, so that one huge group is not one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from litsieve.session import materialise

# how a running value is taken, and how two of them are put together
_KINDS: dict[str, tuple[Callable[[Column], Column], Callable[[Column, Column], Column]]] = {
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
}


def running(df: DataFrame, group: str, order: Sequence[str], value: str, name: str, kind: str = "max") -> DataFrame:
    """Add the running maximum, minimum or sum of a group's values, up to and with each row.

    Rows are sorted in range partitions of (group, order), so a group may lie in many of
    them. Pass one takes a value per group and partition, whose running values over the
    partitions, shifted by one, are what each partition starts from; pass two runs within
    group and partition. NULL values do not count. The order should be total: rows of the same
    place may be taken in either order.
    """
    if kind not in _KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    take, join = _KINDS[kind]
    keys = [group, *order]
    lined = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    lined = materialise(lined.withColumn("_part", F.spark_partition_id()), "lined")
    parts = lined.groupBy(group, "_part").agg(take(F.col(value)).alias("_own"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per group and partition
    starts = parts.select(
        F.col(group).alias("_group"), F.col("_part").alias("_from"), take(F.col("_own")).over(before).alias("_start")
    )
    same = lined[group].eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_from"))
    within = Window.partitionBy(group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = lined.withColumn("_run", take(F.col(value)).over(within)).join(starts, same)
    return rows.select(*df.columns, join(F.col("_start"), F.col("_run")).alias(name))
