"""Subset rules on hand-made tables, hot keys included."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from litsieve.operators import candidates, selection, splits
from litsieve.plans import build
from litsieve.rules import PRODUCTION
from litsieve.sources.tables import Tables

R = PRODUCTION
PEER = R.peer_reviewed


@pytest.fixture(scope="module")
def tables(spark):
    # key, discard, date, review, type, creator
    refs = [
        (1, 0, datetime(2018, 5, 1), 0, PEER, 1000),       # kept after
        (2, 1, datetime(2018, 5, 1), 0, PEER, 1000),       # discarded after
        (3, 1, datetime(2019, 12, 31), 0, PEER, 1000),     # midnight of the end date
        (4, 1, datetime(2019, 12, 31, 10), 0, PEER, 1000),  # later that day: future
        (5, 0, datetime(2017, 1, 1), 0, PEER, 1000),       # start date: two subsets
        (6, 1, datetime(2018, 6, 1), 0, PEER, 1000),       # selected and discarded
        (7, 0, datetime(2018, 6, 1), 1, PEER, 1000),       # review
        (8, 0, datetime(2018, 6, 1), 0, 99, 1000),         # other type
        (9, 0, datetime(2018, 6, 1), 0, PEER, R.goa_creator),     # omitted: only GO
        (10, 1, datetime(2015, 6, 1), 0, PEER, 1000),      # omitted: tag, any date
        (11, 0, datetime(2018, 6, 1), 0, PEER, R.discard_creator),  # back-populated
        (12, 0, datetime(2018, 6, 1), 0, PEER, 1000),      # no text
        (13, 0, datetime(2018, 6, 1), 0, PEER, 1000),      # no ID
        (14, 0, datetime(2018, 6, 1), 0, PEER, 1000),      # GO by the loader only
    ]
    none = ["Not Routed"] * 5
    status = {k: list(none) for k, *_ in refs}
    for k in (1, 6, 7, 8, 11, 12, 13):
        status[k][0] = "Chosen"
    status[5][3] = "Indexed"
    status[9][2] = status[14][2] = "Indexed"
    status[1][2] = "Full-coded"
    parts = [(k, 1, "body", f"text {k}", 1) for k, *_ in refs if k != 12] + [(12, 1, "body", None, 1)]
    wf = [(k, 1, 2, 1000, 1) for k, *_ in refs]
    wf += [(14, R.go_group, R.go_indexed, R.go_loader, 1), (1, R.go_group, R.go_indexed, 1000, 1)]
    acc = [(k, str(100 + k), R.logicaldb, R.object_type, 1) for k, *_ in refs if k != 13]
    acc += [(1, "101b", R.logicaldb, R.object_type, 0), (1, "J:1", 1, R.object_type, 1)]
    make = spark.createDataFrame
    return Tables(
        refs=make(
            [(k, d, t.year, t, v, y, c, "PLoS One", f"title|{k}", f"abstract;;{k}") for k, d, t, v, y, c in refs],
            "refs_key long, isdiscard int, year int, creation_date timestamp, isreview int, ref_type_key long, "
            "createdby_key long, journal string, title string, abstract string",
        ),
        parts=make(parts, "refs_key long, part_no int, text_type string, text_part string, haspdf int"),
        wf_status=make(wf, "refs_key long, group_key long, status_key long, createdby_key long, iscurrent int"),
        tags=make([(10, R.refs_only_tag), (10, 5), (1, 5)], "refs_key long, tag_key long"),
        status=make(
            [(k, *s) for k, s in status.items()],
            "refs_key long, ap_status string, gxd_status string, go_status string, tumor_status string, "
            "qtl_status string",
        ),
        terms=make([(PEER, "Peer Reviewed Article"), (99, "Other")], "term_key long, term string"),
        acc=make(acc, "object_key long, accid string, logicaldb_key long, object_type_key long, preferred int"),
    )


def keys(df):
    return sorted(r.refs_key for r in df.select("refs_key").collect())


def test_bases(tables):
    assert keys(selection.omit_set(tables, R).select("refs_key")) == [9, 10, 14]
    assert keys(selection.base_set(tables, R)) == [1, 2, 3, 4, 5, 6, 7, 8, 13]
    assert keys(selection.base_set(tables, R, "backpopulated")) == [11]
    assert keys(selection.base_set(tables, R, "group")) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14]


@pytest.mark.parametrize(
    "subset, expected",
    [("discard_after", [2, 3, 6]), ("keep_after", [1, 6]), ("keep_before", [5]), ("keep_tumor", [5]),
     ("future_test", [4])],
)
def test_subsets(tables, subset, expected):
    assert keys(selection.subset_records(tables, R, subset)) == expected


def test_unrestricted_and_limit(tables):
    assert keys(selection.subset_records(tables, R, "keep_after", restrict=False)) == [1, 6, 7, 8]
    assert keys(selection.subset_records(tables, R, "keep_after", restrict=False, limit=2)) == [1, 6]


def test_counts(tables):
    counts = {r.subset: r.num for r in selection.subset_counts(tables, R).collect()}
    assert counts == {"omit": 3, "discard_after": 3, "keep_after": 2, "keep_before": 1, "keep_tumor": 1,
                      "future_test": 1}


def test_group_searches(tables):
    def found(group, search):
        return keys(selection.group_records(tables, R, group, search))

    # every ID counts here, the preferred one or not
    assert found("ap", "selected_after") == [1, 1, 11]
    assert found("go", "selected_after") == [1, 1]
    assert found("gxd", "unselected_after") == [2, 3, 4, 6]
    assert found("tumor", "selected_before") == [5]
    with pytest.raises(ValueError):
        selection.search_condition("qtl", "selected_after", R)
    rows = {r.subset: r for r in selection.group_counts(tables, R, "ap").collect()}
    assert rows[f"AP selected_after {R.triage_date}"].num == 2
    assert abs(sum(r.percent for r in rows.values()) - 100) < 1e-9


def test_samples(tables):
    rows = {r.ID: r for r in build.triage_subset(tables, "keep_after").collect()}
    assert set(rows) == {"101", "106"}
    row = rows["101"]
    assert (row.knownClassName, row.creationDate, row.journal) == ("keep", "05/01/2018", "PLoS_One")
    assert (row.title, row.abstract, row.extractedText) == ("title 1", "abstract 1", "text 1")
    assert rows["106"].knownClassName == "discard"
    group = {r.ID: r for r in build.group_subset(tables, "ap", "selected_after").collect()}
    assert (group["101"].knownClassName, group["101"].discardKeep) == ("selected", "keep")


def test_training_sets(tables):
    subsets = {s: build.triage_subset(tables, s) for s in build.AFTER + build.BEFORE}
    out = build.training_sets(subsets, steps=["truncateText"])
    rows = out.collect()
    assert len(rows) == 7
    assert all(r.split == "train" for r in rows if r.subset in build.BEFORE)


def test_prefixes(spark):
    names = spark.createDataFrame([("MCA-K",), ("mcf",), ("HeLa",), ("HeLa",), ("",)], "name string")
    wild = spark.createDataFrame([("MCA*",), ("WEHI*",)], "prefix string")
    assert sorted(r.name for r in selection.not_covered(names, wild).collect()) == ["", "HeLa", "mcf"]
    assert selection.not_covered(names, wild.filter("false")).count() == 4
    assert selection.not_covered(names, spark.createDataFrame([("*",)], "prefix string")).count() == 0


# -- archives ----------------------------------------------------------------


@pytest.mark.parametrize(
    "names, path, reason, others",
    [
        (["a.pdf:5", "x-main.pdf:1", "b.pdf:9"], "x-main.pdf", "m", ["a.pdf"]),
        (["a.pdf:5", "b.pdf:9", "c-s01.pdf:99"], "b.pdf", "s", ["a.pdf", "c-s01.pdf"]),
        (["a.pdf:9", "b.pdf:9", "c.pdf:3"], "a.pdf", "o", ["b.pdf", "c.pdf"]),
        (["only.pdf:1"], "only.pdf", "o", [None]),
        (["fig1.pdf:1", "nihms-12.pdf:1"], "nihms-12.pdf", "m", ["fig1.pdf"]),
        (["data.pdf:7", "empty.pdf:0"], None, None, [None]),
        (["article_3.pdf:1", "b.pdf:2"], "article_3.pdf", "m", [None]),
    ],
)
def test_main_file(spark, names, path, reason, others):
    rows = [("A", i, "d/" + n.split(":")[0], int(n.split(":")[1])) for i, n in enumerate(names)]
    files = spark.createDataFrame(rows, "archive_id string, pos int, path string, size long")
    picked = candidates.main_file(files).first()
    assert (picked.path, picked.reason) == (path and "d/" + path, reason)
    log = candidates.main_file_log(files).orderBy("other_pos").collect()
    assert [r.other for r in log] == others


def test_outcomes(spark):
    rows = [("1", None, "research-article"), ("2", "20", "research-article"), ("3", "30", "letter"),
            ("4", "40", "poem"), ("5", "50", "research-article")]
    df = spark.createDataFrame(rows, "pmcid string, pmid string, type string").withColumns(
        {"journal": F.lit("J"), "has_pdf": F.lit(False), "has_body": F.lit(True)}
    )
    known = spark.createDataFrame([("20",), ("20",)], "pmid string")
    out = candidates.with_outcome(df, known)
    assert [r.outcome for r in out.orderBy("pmcid").collect()] == [
        "no_pmid", "in_db", "skipped_type", "new_type", "wanted"
    ]
    report = candidates.outcome_report(out).first()
    assert (report.found, report.no_pdf, report.matching) == (5, 1, 0)
    examples = {r.outcome: r.examples for r in candidates.outcome_examples(out).collect()}
    # known articles and those without a PDF are listed by PMID, others by archive ID
    assert (examples["new_type"], examples["no_pdf"], examples["in_db"]) == ("4", "50", "20")


def test_candidate_search(spark):
    rows = [("J", "2015-06-01", True, "Mice here", ""), ("J", "2015-06-01", True, "micelles", ""),
            ("J", "2017-06-01", True, "mice", ""), ("K", "2015-06-01", True, "mice", ""),
            ("J", "2015-06-01", False, "mice", "")]
    df = spark.createDataFrame(
        rows, "journal string, d string, open_access boolean, title string, text string"
    ).withColumn("creation_date", F.to_timestamp("d"))
    journals = spark.createDataFrame([("J",)], "journal string")

    def found(**kw):
        return candidates.candidate_search(
            df, journals, "2010-01-01", "2016-12-31", ("title", "text"), **kw
        ).count()

    assert (found(), found(mice_only=False)) == (1, 2)


# -- hot keys and splits -----------------------------------------------------


def test_hot_archive_and_journal(spark):
    """A third of all rows in one group gives the same answers as the rest."""
    n = 30_000
    files = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).alias("archive_id"),
        F.col("id").alias("pos"),
        F.concat(F.lit("d/f"), F.col("id").cast("string"), F.lit("a.pdf")).alias("path"),
        (F.col("id") * 7919 % 1_000_003 + 1).alias("size"),
    )
    rows = {}
    for r in files.collect():
        best = rows.get(r.archive_id)
        if best is None or r["size"] > best["size"]:
            rows[r.archive_id] = r
    picked = {r.archive_id: r.path for r in candidates.main_file(files).collect()}
    assert picked == {k: r.path for k, r in rows.items()}
    assert candidates.main_file_log(files).filter("other IS NOT NULL").count() == n - len(rows)


def test_split_is_a_partition_of_the_input(spark):
    df = spark.range(20_000).withColumn("ID", F.col("id").cast("string"))
    a = splits.split_random(df, "ID", 0.2, seed=5)
    b = splits.split_random(df.repartition(13), "ID", 0.2, seed=5)
    kept = a.filter("retained").select("ID")
    assert kept.exceptAll(b.filter("retained").select("ID")).count() == 0
    assert 3_700 < kept.count() < 4_300
    other = splits.split_random(df, "ID", 0.2, seed=6).filter("retained").select("ID")
    assert kept.intersect(other).count() < 1_200


def test_three_way_shares(spark):
    df = spark.range(40_000).withColumn("ID", F.col("id").cast("string"))
    out = splits.split_three_way(df, "ID", F.col("id") < 20_000, seed=2)
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert 0.14 < counts["test"] / 20_000 < 0.16 and 0.19 < counts["val"] / 20_000 < 0.21
    assert out.filter("id >= 20000 AND split <> 'train'").count() == 0


def test_text_flag_and_limit(tables):
    from dataclasses import replace

    from litsieve.sources.tables import flag_text

    flagged = replace(tables, parts=flag_text(tables.parts))
    assert keys(selection.base_set(flagged, R)) == keys(selection.base_set(tables, R))
    limited = build.triage_subset(tables, "keep_after", restrict=False, limit=3)
    assert {r.ID for r in limited.collect()} == {"101", "106", "107"}
