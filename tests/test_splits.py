"""Shares of the registered split, and independence of draws."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from litsieve.operators.splits import hash_draw
from litsieve.plans.catalog.views import Inputs


def test_three_way_shares_of_the_registered_query(spark):
    folder = "/root/testdata/sf0.1"  # rows enough for a point to mean something
    split = __spark_entry__.queries()["split_three_way"](spark, folder)
    refs = Inputs(spark, folder).view("refs").select("refs_key", "creation_date")
    after = F.col("creation_date") > F.to_timestamp(F.lit("1998-10-31"))
    rows = split.join(refs, "refs_key").groupBy("split").agg(
        F.sum(after.cast("int")).alias("after"), F.sum((~after).cast("int")).alias("before")
    ).collect()
    total = sum(r.after for r in rows)
    share = {r.split: r.after / total for r in rows}
    assert share["test"] == pytest.approx(0.15, abs=0.01)
    assert share["val"] == pytest.approx(0.20, abs=0.01)
    assert share["train"] == pytest.approx(0.65, abs=0.01)
    assert all(r.before == 0 for r in rows if r.split != "train")


def test_draws_of_two_seeds_are_independent(spark):
    keys = spark.range(50_000)
    pair = keys.select(hash_draw(F.col("id"), 3).alias("a"), hash_draw(F.col("id"), 4).alias("b"))
    row = pair.agg(
        F.corr("a", "b").alias("r"), F.avg("a").alias("mean"), F.count_distinct("a").alias("n"),
        F.avg(((F.col("a") < 0.15) & (F.col("b") < 0.235)).cast("int")).alias("both"),
    ).first()
    assert abs(row.r) < 0.02 and row.n > 49_000
    assert row["mean"] == pytest.approx(0.5, abs=0.01)
    assert row.both == pytest.approx(0.15 * 0.235, abs=0.005)
