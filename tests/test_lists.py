"""Archive index: order of lines, malformed lines; articles wanted without a body."""

from __future__ import annotations

import pytest

from litsieve.plans.backfill import backfill
from litsieve.sources import lists


def index(tmp_path, *lines):
    path = tmp_path / "index.txt"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


HEAD = "2017-04-01 21:19:07"


def test_last_line_of_a_pmid_counts(spark, tmp_path):
    path = index(tmp_path, HEAD, "f\tc\tPMC9\tPMID:1\tx", "f\tc\tPMC10\tPMID:1\tx", "f\tc\tPMC7\tPMID:" + "2" * 30)
    ids = spark.createDataFrame([("1",), ("2" * 30,)], "pmid string")
    got = lists.map_ids(ids, lists.read_archive_index(spark, path)).collect()
    assert {(r.pmid, r.pmcid) for r in got} == {("1", "PMC10"), ("2" * 30, "PMC7")}


def test_short_lines_fail_or_are_kept_apart(spark, tmp_path):
    path = index(tmp_path, HEAD, "f\tc\tPMC9\tPMID:1\tx", "f\tc")
    with pytest.raises(Exception, match="short index line"):
        lists.read_archive_index(spark, path).collect()
    rows = lists.read_archive_index(spark, path, quarantine=True).collect()
    assert sorted((r.pmid or "", r.malformed or "") for r in rows) == [("", "f\tc"), ("1", "")]


def test_articles_without_a_body_are_wanted(spark):
    articles = spark.createDataFrame(
        [("J", "PMC1", "1", "research-article", False, "t"), ("J", "PMC2", "2", "research-article", True, "t")],
        "journal string, pmcid string, pmid string, type string, has_body boolean, text string",
    )
    known = spark.createDataFrame([], "pmid string")
    files = spark.createDataFrame([("PMC1", 1, "PMC1/main.pdf", 5)], "pmcid string, pos int, path string, size long")
    job = backfill(articles, known, files)
    assert sorted(r.pmcid for r in job.wanted.collect()) == ["PMC1", "PMC2"]
    assert job.report.first().text_written == 2
