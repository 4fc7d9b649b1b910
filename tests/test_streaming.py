"""Stateful streams against the batch jobs on the same rows."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from litsieve.operators import candidates, texts
from litsieve.streaming import arrivals, assembly
from litsieve.streaming.state import append

TYPES = ["body", "reference", "star methods", "supplemental", "unknown kind", None]
PARTS = "refs_key long, part_no int, text_type string, text_part string"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Every partition keeps a state store of its own, which opens and closes per batch."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / n) for n in ("in", "out", "state")]


def _parts(n=120, seed=1):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(20), rnd.randrange(4), rnd.choice(TYPES), f"text {i} ä\n") for i in range(n)]
    rows += [(3, None, "body", "no number"), (3, 1, "body", None), (99, 1, "body", None), (5, 1, "body", "")]
    rows += rows[:4]  # repeated rows are repeated text, as in the batch job
    rnd.shuffle(rows)
    return rows


def _run(spark, folders, rows, **options):
    inbox, out, state = folders
    df = spark.createDataFrame(rows, PARTS).coalesce(1)
    df.write.mode("append").parquet(inbox)
    parts = assembly.stream_parts(spark, inbox, PARTS, files_per_trigger=1)
    job = append(assembly.assemble_stream(parts, **options), out, state, once=True)
    assert job.awaitTermination(100)


def _batch(spark, rows):
    return {tuple(r) for r in texts.assemble_text(spark.createDataFrame(rows, PARTS)).collect()}


def test_last_version_is_the_batch_text(spark, folders):
    """Every run is a restart from the checkpoint; late parts give new versions."""
    rows = _parts()
    for upto in range(0, len(rows), 45):
        _run(spark, folders, rows[upto : upto + 45])
        given = spark.read.parquet(folders[1])
        got = {tuple(r) for r in assembly.latest_texts(given).collect()}
        assert got == _batch(spark, rows[: upto + 45])
    versions = given.groupBy("refs_key").agg(F.count("*").alias("n"), F.max("version").alias("last")).collect()
    assert all(r.n == r["last"] for r in versions) and max(r.n for r in versions) > 1
    assert given.filter("not complete").isEmpty()


def test_nothing_new_gives_nothing(spark, folders):
    rows = _parts(30)
    _run(spark, folders, rows)
    before = spark.read.parquet(folders[1]).count()
    inbox, out, state = folders
    parts = assembly.stream_parts(spark, inbox, PARTS)
    assert append(assembly.assemble_stream(parts), out, state, once=True).awaitTermination(60)
    assert spark.read.parquet(out).count() == before


def _until(done, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        if done():
            return
        time.sleep(0.5)
    raise AssertionError("did not get there")


def test_quiet_and_forgotten_articles(spark, folders):
    """A text waits for its timer; parts beyond the time of keeping are told apart."""
    inbox, out, state = folders
    one = [(1, 2, "body", "b"), (2, 1, "body", "x")]
    spark.createDataFrame(one, PARTS).coalesce(1).write.mode("append").parquet(inbox)
    parts = assembly.stream_parts(spark, inbox, PARTS)
    job = append(assembly.assemble_stream(parts, quiet=1500, retain=2500), out, state)

    def given():
        return {(r.refs_key, r.version): (r.ext_text, r.complete) for r in spark.read.schema(
            "refs_key long, ext_text string, version long, complete boolean").parquet(out).collect()}

    try:
        _until(lambda: len(given()) == 2)
        assert given() == {(1, 1): ("b", True), (2, 1): ("x", True)}
        time.sleep(6)  # beyond the time of keeping
        late = [(1, 1, "body", "a")]
        spark.createDataFrame(late, PARTS).coalesce(1).write.mode("append").parquet(inbox)
        _until(lambda: (1, 2) in given())
        assert given()[1, 2] == ("a", False)
    finally:
        job.stop()


ARTICLES = "pmcid long, pmid long, journal string, type string"


def _arrive(spark, folders, rows, known):
    inbox, out, state = folders
    spark.createDataFrame(rows, ARTICLES).coalesce(1).write.mode("append").parquet(inbox)
    articles = spark.readStream.schema(ARTICLES).option("maxFilesPerTrigger", 1).parquet(inbox)
    rows = arrivals.outcome_stream(articles, known)
    assert append(rows, out, state, once=True).awaitTermination(60)
    return sorted(map(tuple, spark.read.parquet(out).collect()), key=repr)


def test_arrivals_equal_the_batch_outcome(spark, folders):
    rnd = random.Random(4)
    kinds = ["research-article", "letter", "brand-new", None]
    rows = [(i, rnd.choice([None, rnd.randrange(60)]), f"J{i % 3}", rnd.choice(kinds)) for i in range(90)]
    known = spark.createDataFrame([(i,) for i in range(0, 60, 2)] + [(4,), (None,)], "pmid long")
    for upto in (30, 60, 90):
        got = _arrive(spark, folders, rows[upto - 30 : upto], known)
        # the file of the week before is delivered again
        assert _arrive(spark, folders, rows[max(upto - 45, 0) : upto], known) == got
        batch = candidates.with_outcome(spark.createDataFrame(rows[:upto], ARTICLES), known)
        assert got == sorted(map(tuple, batch.collect()), key=repr)


def _python_calls(rows):
    return "transformwithstate" in rows._jdf.queryExecution().toString().lower()


def test_streams_without_timers_make_no_call_per_key(spark, folders):
    """A call of Python per article, which took the whole time, is left to streams with timers."""
    inbox = folders[0]
    spark.createDataFrame([], PARTS).write.parquet(inbox)
    parts = assembly.stream_parts(spark, inbox, PARTS)
    assert not _python_calls(assembly.assemble_stream(parts))
    assert _python_calls(assembly.assemble_stream(parts, quiet=1000))
    articles = spark.readStream.schema(ARTICLES).parquet(inbox)
    known = spark.createDataFrame([(1,)], "pmid long")
    assert not _python_calls(arrivals.outcome_stream(articles, known))
    assert _python_calls(arrivals.outcome_stream(articles, known, remember=1000))
