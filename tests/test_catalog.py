"""Every query against its SQL, and against itself with other partition counts."""

from __future__ import annotations

import pytest

import __spark_entry__
import oracle

QUERIES = __spark_entry__.queries()
ORACLES = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, con, name):
    assert oracle.compare(QUERIES[name](spark, folder), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


@pytest.mark.parametrize(
    "name",
    ["to_sample", "subset_counts", "fig_close_words", "vocab_df", "split_summary", "small_build",
     "main_file_log", "outcome_examples", "vocab_probe"],
)
def test_partition_count_does_not_matter(spark, folder, name):
    results = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            df = QUERIES[name](spark, folder)
            results.append(oracle.rows(df.columns, df.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0
