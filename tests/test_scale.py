"""Filters, scans and layouts that keep large jobs in bounds."""

from __future__ import annotations

import random
from collections import Counter
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from litsieve import session
from litsieve.operators import running, selection, texts
from litsieve.operators.bloom import bloom_filter
from litsieve.plans import build
from litsieve.plans.catalog import views
from litsieve.plans.catalog.views import RULES, Inputs
from litsieve.sources import tables


# -- Bloom filter


@pytest.mark.parametrize("kind", ["long", "string"])
def test_bloom_filter(spark, kind):
    keys = spark.range(0, 60_000, 3).select(F.col("id").cast(kind).alias("k")).union(spark.sql(f"SELECT CAST(NULL AS {kind}) k"))
    rows = spark.range(0, 60_000).select(F.col("id").cast(kind).alias("k"), F.lit("own").alias("_bits"))
    rows = rows.union(rows.limit(5))
    bloom = bloom_filter(keys, "k")
    kept = bloom.keep(rows, "k")
    assert kept.columns == rows.columns
    got = Counter(int(r.k) for r in kept.collect())
    assert all(got[k] for k in range(0, 60_000, 3)), "a key that was put in is lost"
    others = sum(1 for k in got if k % 3)
    assert others / 40_000 < 0.05
    joined = kept.join(keys, "k", "left_semi")
    assert joined.count() == rows.join(keys, "k", "left_semi").count()


def test_bloom_filter_bounds(spark):
    keys = spark.range(1000)
    assert bloom_filter(keys, "id", limit=1000) is None
    nothing = bloom_filter(keys.limit(0), "id")
    assert nothing.keep(keys, "id").count() == 0


def test_parts_are_dropped_in_the_scan(spark, folder):
    """What reaches the shuffle of the parts: those of chosen articles, and a few more."""
    parts = Inputs(spark, folder).view("parts")
    keys = parts.select("refs_key").distinct().filter("refs_key % 5 = 0")
    bloom = bloom_filter(keys, "refs_key")
    wanted = parts.join(keys, "refs_key", "left_semi").count()
    kept = bloom.keep(parts, "refs_key").count()
    assert wanted <= kept <= wanted + 0.06 * (parts.count() - wanted) + 5
    plain = texts.assemble_text(parts, keys=keys)
    filtered = texts.assemble_text(parts, keys=keys, likely=bloom)
    assert plain.exceptAll(filtered).isEmpty() and filtered.exceptAll(plain).isEmpty()


def test_subset_through_the_filter(spark, folder, monkeypatch):
    t = Inputs(spark, folder).tables()
    plain = sorted(map(tuple, build.triage_subset(t, "keep_after", RULES, restrict=False).collect()))
    monkeypatch.setattr(build, "BROADCAST_KEYS", 0)
    assert sorted(map(tuple, build.triage_subset(t, "keep_after", RULES, restrict=False).collect())) == plain and plain


# -- running aggregates


@pytest.mark.parametrize("kind,step", [("max", max), ("min", min), ("sum", lambda a, b: a + b)])
@pytest.mark.parametrize("archives", [1, 6])
def test_running(spark, kind, step, archives):
    rnd = random.Random(archives)
    rows = [(rnd.choice([None, *"abcde"][:archives + 1]) if archives > 1 else "a", i, rnd.randrange(10**6)) for i in range(3000)]
    df = spark.createDataFrame(rows, "archive string, pos int, size long").repartition(7)
    got = {(r.archive, r.pos): r.top for r in running.running(df, "archive", ["pos"], "size", "top", kind).collect()}
    want = {}
    for a in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == a]
        for r, top in zip(own, accumulate((r[2] for r in own), step)):
            want[a, r[1]] = top
    assert got == want


def test_running_skips_missing_values(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None), ("a", 4, 3)], "g string, pos int, v long")
    for kind, want in (("max", [None, 5, 5, 5]), ("min", [None, 5, 5, 3]), ("sum", [None, 5, 5, 8])):
        rows = running.running(df, "g", ["pos"], "v", "top", kind).orderBy("pos").collect()
        assert [r.top for r in rows] == want
    assert running.running(df.limit(0), "g", ["pos"], "v", "top").count() == 0
    with pytest.raises(ValueError):
        running.running(df, "g", ["pos"], "v", "top", "median")


def test_one_archive_is_many_tasks(spark):
    """Neither pass sees the whole group, where tasks are not merged for being small."""
    df = spark.range(20_000).select(F.lit("one").alias("g"), F.col("id").alias("pos"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = running.running(df, "g", ["pos"], "v", "top")
        sizes = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert sizes <= 20_000 * 0.6 and rows.filter("top <> pos").isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# -- JDBC ranges


def _ranges(spark, values, n):
    df = spark.createDataFrame([(v,) for v in values], "k long")
    cuts = tables.key_cuts(df, "k", n)
    predicates = tables.range_predicates("k", cuts)
    return df, [df.filter(p).count() for p in predicates]


def test_ranges_of_skewed_keys(spark):
    rnd = random.Random(5)
    values = [int(2 ** (rnd.random() * 40)) for _ in range(8000)]  # crowded at the low end
    df, sizes = _ranges(spark, values, 16)
    assert sum(sizes) == 8000 and max(sizes) <= 8000 / 16 * 1.3 and len(sizes) == 16
    even = [df.filter(f"k > {i * 2**36} AND k <= {(i + 1) * 2**36}").count() for i in range(16)]
    assert max(even) > 4 * max(sizes)  # what equal steps would do


def test_ranges_hold_every_row_once(spark):
    for values in ([], [None], [7] * 100, [None, 1, 1, 2, 2**62, -5], list(range(50))):
        _, sizes = _ranges(spark, values, 8)
        assert sum(sizes) == len(values)


# -- co-located tables


def test_bucketed_tables_join_in_place(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS colocated")
    plain = Inputs(spark, folder).tables()
    tables.store_bucketed(plain, "colocated", 4, mode="overwrite")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = tables.from_catalog(spark, "colocated")
        records = selection.subset_records(t, RULES, "keep_after", restrict=False)
        plan = records._jdf.queryExecution().executedPlan().toString()
        assert _shuffled_tables(plan) <= {"terms"}, plan
        assembled = texts.assemble_text(t.parts)
        assert _shuffled_tables(assembled._jdf.queryExecution().executedPlan().toString()) == set()
        spark.conf.set("spark.sql.sources.bucketing.enabled", "false")
        apart = selection.subset_records(t, RULES, "keep_after", restrict=False)
        plan = apart._jdf.queryExecution().executedPlan().toString()
        assert {"refs", "status", "acc", "wf_status"} <= _shuffled_tables(plan)
        want = selection.subset_records(plain, RULES, "keep_after", restrict=False)
        assert records.exceptAll(want).isEmpty() and want.exceptAll(records).isEmpty()
    finally:
        spark.conf.set("spark.sql.sources.bucketing.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP DATABASE colocated CASCADE")


def _shuffled_tables(plan: str) -> set[str]:
    """Tables whose rows an exchange moves before anything is joined to them."""
    lines = plan.split("\n== Initial Plan ==")[0].splitlines()
    out = set()
    for i, line in enumerate(lines):
        if "FileScan" not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        for above in reversed(lines[:i]):
            own = len(above) - len(above.lstrip(" :+-*()0123456789"))
            if own >= depth:
                continue
            depth = own
            if "Join" in above:
                break
            if "Exchange hashpartitioning" in above:
                out.add(line.split("colocated.")[1].split("[")[0])
                break
    return out


# -- Tasks that follow the size of a table


def test_tasks_of_a_grouped_table_follow_its_rows(spark, folder, monkeypatch):
    """Eight tasks whatever the table had made the sorts of each grow with it."""
    assert session.deal(spark.range(0, 10_000, 1, 1), "id", rows=100).rdd.getNumPartitions() == 100
    plain = Inputs(spark, folder).view("files")
    monkeypatch.setattr(views, "deal", lambda df, *keys: session.deal(df, *keys, rows=200))
    dealt = Inputs(spark, folder).view("files")
    lines = Inputs(spark, folder).table("lineitem").count()
    assert dealt.rdd.getNumPartitions() == -(-lines // 200) > 8
    assert plain.exceptAll(dealt).isEmpty() and dealt.exceptAll(plain).isEmpty()
