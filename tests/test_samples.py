"""Sample records, labels, rejects, side inputs."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from litsieve import schema
from litsieve.operators import preprocess as pre
from litsieve.operators import splits, reports, texts
from litsieve.sources import archive, lists, predictions, samples

ONE = "discard|pm-1|03/04/2018|2018|1|Peer Reviewed|x|Rejected|b|c|d|e|Cell|A title|Some words|All words"
TWO = (
    "keep|pm-2|11/12/2019|2019|0|Other|x|Chosen|b|c|d|e|Journal of Sleep|Second title|\n"
    "Second words|A line\n\nand another one -/-.\n"
)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf8")


def test_read_with_meta_and_header(spark, tmp_path):
    kind = schema.PRIM_TRIAGE
    write(
        tmp_path / "in" / "part",
        f"#meta sampleObjType={kind.name} date=09/18/2019;;{kind.header};;{ONE};;\n{TWO};;\n",
    )
    path = str(tmp_path / "in")
    assert samples.read_meta(spark, path)["date"] == "09/18/2019"
    rows = samples.read_samples(spark, path).orderBy("ID").collect()
    assert [r.ID for r in rows] == ["pm-1", "pm-2"]
    assert "|".join(rows[0]) == ONE and "|".join(rows[1]) == TWO


def test_write_read(spark, tmp_path):
    kind = schema.PRIM_TRIAGE
    records = spark.createDataFrame([(ONE,), (TWO,)], "value string")
    df = samples.parse_records(records, kind)
    path = str(tmp_path / "out")
    samples.write_samples(df, path, kind, {"host": "h"})
    back = samples.read_samples(spark, path)
    assert back.exceptAll(df).count() == 0 and back.count() == 2
    samples.stamp_meta(spark, path, {"sampleObjType": kind.name, "date": "today"})
    assert samples.read_meta(spark, path) == {"sampleObjType": kind.name, "date": "today"}


def test_final_semicolon(spark, tmp_path):
    write(tmp_path / "in" / "part", "1|t|a|text;;;;2|t|a|more;;;3|t|a|last;;")
    got = samples.read_samples(spark, str(tmp_path / "in"), schema.REF).orderBy("ID").collect()
    assert [r.ID for r in got] == ["1", "2", "3"]
    df = spark.createDataFrame([("1", "t", "a", "ends in ;")], schema.REF.struct)
    path = str(tmp_path / "out")
    samples.write_samples(df, path, schema.REF)
    assert samples.read_samples(spark, path).first().extractedText == "ends in ; "


def test_wrong_width_fails(spark):
    bad = spark.createDataFrame([("keep|only|three",)], "value string")
    with pytest.raises(PySparkException):
        samples.parse_records(bad, schema.PRIM_TRIAGE).collect()


def test_fields_and_classes():
    kind = schema.PRIM_TRIAGE
    assert len(kind.fields) == 16 and len(schema.CUR_GROUP.fields) == 17
    assert (kind.positive_class, schema.CUR_GROUP.positive_class) == ("keep", "selected")
    assert "apStatus" in kind.header and "year" in kind.extra_info
    with pytest.raises(KeyError):
        kind.check_field("foo")
    with pytest.raises(ValueError):
        schema.sample_type("Other")


def test_conform_ignores_unknown_and_fills_missing(spark):
    df = spark.createDataFrame([("keep", "pm-4", "text", "x")], "knownClassName string, ID string, extractedText string, foo string")
    row = schema.PRIM_TRIAGE.conform(df).first()
    assert (row.ID, row.journal, row.extractedText) == ("pm-4", "", "text")


def test_class_names(spark):
    df = spark.createDataFrame([(";discard",), ("keep",)], "knownClassName string")
    checked = schema.validate_class(df, schema.PRIM_TRIAGE)
    assert [r.knownClassName for r in checked.collect()] == ["discard", "keep"]
    ys = checked.select(schema.PRIM_TRIAGE.y().alias("y")).collect()
    assert [r.y for r in ys] == [0, 1]
    bad = spark.createDataFrame([("bad",)], "knownClassName string")
    with pytest.raises(PySparkException):
        schema.validate_class(bad, schema.PRIM_TRIAGE).collect()
    row = schema.validate_class(bad, schema.PRIM_TRIAGE, quarantine=True).first()
    assert row.reject and "bad" in row.reject_reason


def test_rejects(spark):
    df = spark.createDataFrame([("a",), ("b",)], "ID string")
    marked = schema.set_reject(df, F.col("ID") == "a", "my reason")
    assert marked.count() == 2 and schema.omit_rejects(marked).count() == 1
    again = schema.set_reject(marked, F.lit(True), "later").orderBy("ID").collect()
    assert [r.reject_reason for r in again] == ["my reason", "later"]


def test_union_needs_one_type(spark):
    df = schema.REF.conform(spark.createDataFrame([("1",)], "ID string"))
    assert samples.union_samples([(df, schema.REF), (df, schema.REF)]).count() == 2
    with pytest.raises(ValueError):
        samples.union_samples([(df, schema.REF), (df, schema.PRIM_TRIAGE_UNCLASSIFIED)])


def test_preprocess_chain(spark):
    # A published example and its result.
    df = spark.createDataFrame(
        [("pmID3", "My Title", "\nMy Abstract: w/ http://url.org end abstract",
          "\nMy text: https://foo text www.foo.org and text.\n")],
        "ID string, title string, abstract string, extractedText string",
    )
    out = pre.preprocess(df, ["removeURLs", "tokenPerLine"])
    doc = out.select(pre.document(out).alias("d")).first().d
    assert doc == "my\ntitle\n\nmy\nabstract\nw\nend\nabstract\n\nmy\ntext\ntext\nand\ntext\n"
    with pytest.raises(ValueError):
        pre.preprocess(df, ["nothing"])


def test_text_assembly(spark):
    parts = spark.createDataFrame(
        [(1, 5, "author manuscript fig legends", "+legends"), (1, 4, "star methods", "+star"),
         (1, 3, "supplemental", "+extra"), (1, 2, "reference", "+refs"), (1, 1, "body", "body"),
         (2, 1, "body", "other body"), (3, 1, "supplemental", "unused"), (3, 2, "body", None)],
        "refs_key long, part_no int, text_type string, text_part string",
    )
    refs = spark.createDataFrame([(1,), (2,), (9,)], "refs_key long")
    joined = texts.join_text(refs, texts.assemble_text(parts, keys=refs)).orderBy("refs_key").collect()
    assert [r.ext_text for r in joined] == [
        "body+refs+legends+star+extra", "other body", "",
    ]
    with pytest.raises(PySparkException):
        texts.join_text(refs, texts.assemble_text(parts), allow_no_text=False).collect()


def test_text_cleaning(one):
    from litsieve.functions import clean

    assert one(["a;;b|c;d", "café \U0001F600x", None], clean.clean_text) == ["a b c;d", "caf   x", ""]
    assert one(["a\nbcd"], lambda c: clean.ingest_text(c, 3)) == ["a b\n"]
    assert one([None], lambda c: clean.clean_text(c, null_as="None")) == ["None"]
    urls = ["see doing http://x.y/z now", "DOI:10.1/x end"]
    assert one(urls, clean.remove_urls) == ["see   now", " end"]
    assert one(urls, lambda c: clean.remove_urls(c, strict_doi=True)) == ["see doing  now", " end"]
    assert one(["A 2b _x y9"], clean.clean_tokens) == [" _x y9"]
    assert one(["  PLoS One \n"], clean.normalise_journal) == ["plos_one"]


def test_journal_report(spark):
    df = spark.createDataFrame([("j1", "keep"), ("j1", "keep"), ("j2", "keep")], "journal string, c string")
    rows = {r.journal: r for r in reports.journal_distribution(df, F.col("c") == "keep").collect()}
    assert (rows["j1"].articles, round(rows["j1"].pos_pct, 2), rows["j1"].neg_pct) == (2, 66.67, 0.0)
    assert (rows["Totals"].articles, rows["Totals"].neg, rows["Totals"].neg_pct) == (3, 0, 100.0)


def test_journal_without_recent_articles(spark):
    df = spark.createDataFrame(
        [("old", "2011-01-01"), ("new", "2017-01-01"), ("new", "2009-12-31")], "journal string, d string"
    ).select("journal", F.to_timestamp("d").alias("creation_date"))
    rows = {r.journal: r[1:] for r in reports.journal_windows(df).collect()}
    assert rows == {"old": (1, None), "new": (1, 1)}


def test_class_balance(spark):
    df = spark.createDataFrame([("t", "discard"), ("t", "keep"), ("t", "discard")], "split string, c string")
    row = splits.class_balance(df, F.col("c") == "keep").first()
    assert (row.samples, row.positive, row.negative) == (3, 1, 2)


def test_predictions(spark, tmp_path):
    values = [f"V{i}" for i in range(19)]
    path = str(tmp_path / "pred")
    df = spark.createDataFrame([values], list(schema.PREDICTION_FIELDS))
    predictions.write_predictions(df, path)
    row = predictions.read_predictions(spark, path).first()
    assert list(row) == [v.lower() for v in values]
    assert predictions.long_output(df).columns[:4] == ["ID", "True Class", "Pred Class", "FP/FN"]
    with pytest.raises(PySparkException):
        predictions.parse_predictions(spark.createDataFrame([("a|b",)], "value string")).collect()


def test_id_lists(spark, tmp_path):
    write(tmp_path / "ids.tsv", "pubmed\thaspdf\tyear\tjournal\n1\t1\t2010\tJ\n2\t0\t2011\tK\n")
    assert [r.pubmed for r in lists.read_known_ids(spark, str(tmp_path / "ids.tsv")).collect()] == ["1", "2"]
    write(tmp_path / "oa.txt", "2019-01-01 10:00:00\noa/a.tar.gz\tJ 2010\tPMC11\tPMID:1\tCC\n")
    id_map = lists.read_archive_index(spark, str(tmp_path / "oa.txt"))
    assert [(r.pmid, r.pmcid) for r in id_map.collect()] == [("1", "PMC11")]
    df = spark.createDataFrame([("1",), ("2",)], "pmid string")
    assert lists.map_ids(df, id_map, quarantine=True).filter("pmcid IS NULL").count() == 1
    with pytest.raises(PySparkException):
        lists.map_ids(df, id_map).collect()
    write(tmp_path / "j.txt", "Aging Cell\n aging cell \nCell\n\n")
    assert {r.journal for r in lists.read_journals(spark, str(tmp_path / "j.txt")).collect()} == {"aging_cell", "cell"}


def test_known_id_export(spark, tmp_path):
    rows = [(str(i), "1", str(2010 + i % 3), f"J{i % 4}") for i in range(50)]
    df = spark.createDataFrame(rows, lists.KNOWN_ID_SCHEMA).orderBy("journal", "pubmed")
    path = str(tmp_path / "ids")
    lists.write_known_ids(df, path)
    back = lists.read_known_ids(spark, path)
    assert back.count() == 50 and back.exceptAll(df).count() == 0


def test_text_folders(spark, tmp_path):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "PLoS One").otherwise(F.concat(F.lit("J "), F.col("id") % 7)).alias("journal"),
        F.col("id").cast("string").alias("text"),
    )
    archive.write_by_journal(df, str(tmp_path / "out"))
    folders = {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()}
    assert "journal=PLoS_One" in folders and len(folders) == 8
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1000


def test_articles(spark, tmp_path):
    write(
        tmp_path / "xml" / "a.xml",
        '<?xml version="1.0"?>\n<set>\n<article article-type="research-article"><front><article-meta>'
        '<article-id pub-id-type="pmid">111</article-id><article-id pub-id-type="pmc">222</article-id>'
        "</article-meta></front><body><p>Fish &amp; <b>chïps</b> &lt;5</p></body></article>\n"
        '<article article-type="letter"><front><article-meta><article-id pub-id-type="pmc">333</article-id>'
        "</article-meta></front></article>\n</set>\n",
    )
    rows = archive.read_articles(spark, str(tmp_path / "xml")).orderBy("pmcid").collect()
    assert [(r.type, r.pmcid, r.pmid, r.has_body) for r in rows] == [
        ("research-article", "222", "111", True), ("letter", "333", None, False)
    ]
    assert rows[0].text == "111222Fish & ch ps <5"


def test_listing(spark):
    linux = "-rw-rw-r-- pmc/dev 15103630 2017-04-01 21:19 PMC5/ACEL-s001.pdf"
    mac = "-rw-r--r--  0 user group 77 Apr  1 2017 PMC5/x.pdf"
    df = spark.createDataFrame([("1", linux), ("1", linux + ".txt")], "a string, value string")
    assert [tuple(r) for r in archive.parse_listing(df).collect()] == [("1", "PMC5/ACEL-s001.pdf", 15103630)]
    df = spark.createDataFrame([(mac,)], "value string")
    assert archive.parse_listing(df, size_field=4).first().size == 77


def test_side_texts(spark, tmp_path):
    write(tmp_path / "side" / "7.new.txt", "new\ntext")
    write(tmp_path / "side" / "8.old.txt", "no")
    df = spark.createDataFrame([("7", "old"), ("8", "kept")], "ID string, extractedText string")
    side = archive.read_side_texts(spark, str(tmp_path / "side"))
    rows = archive.replace_text(df, side).orderBy("ID").collect()
    assert [r.extractedText for r in rows] == ["new\ntext", "kept"]


def test_records_to_lines(spark):
    df = spark.createDataFrame([("a;;b;;",), ("no end",)], "value string")
    assert [r.value for r in samples.records_to_lines(df).collect()] == ["a", ";;b", ";;"]
