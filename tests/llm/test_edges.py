"""Every operator and stage on odd rows, an empty table and empty side tables."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from litsieve.llm import (
    decontam,
    exact_dedup,
    html_extract,
    license_scan,
    manifest,
    mixing,
    pii,
    quality,
    secret_scan,
    simhash,
    spelling,
    substring_dedup,
    toxicity,
)

PER_ROW = {
    "toxicity": lambda d, j, i: toxicity.scored(d, j),
    "pii": lambda d, j, i: pii.scanned(d),
    "mixing": lambda d, j, i: mixing.taken(d),
    "secrets": lambda d, j, i: secret_scan.scanned(d),
    "quality": lambda d, j, i: quality.judged(d, j),
    "repeats": lambda d, j, i: substring_dedup.deduplicated(d),
    "licenses": lambda d, j, i: license_scan.scanned(d),
    "simhash": lambda d, j, i: simhash.linked(d),
    "exact": lambda d, j, i: exact_dedup.classes(d),
    "manifest": lambda d, j, i: manifest.audited(d, levels=2),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_each(odd, judged, items, name):
    got = PER_ROW[name](odd, judged, items).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in odd.select("doc_id").collect())


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_tables(none, judged, items, name):
    assert PER_ROW[name](none, judged.limit(0), items.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["toxicity", "quality"])
def test_without_labels(odd, judged, name):
    assert PER_ROW[name](odd, judged.limit(0), None).count() == odd.count()


def test_decontamination(odd, none, items):
    assert decontam.contaminated(odd, items).collect() == []
    assert decontam.contaminated(odd, items.limit(0)).collect() == []
    assert decontam.contaminated(none, items).collect() == []
    assert decontam.keep_clean(odd, items).columns == odd.columns
    assert decontam.keep_clean(odd, items).count() == odd.count()


def test_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>a<b"), (3, "u", "<p>a<b"), (None, "u", "<div>" * 3000 + "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_extract.extracted(df).collect()
    assert len(got) == 5 and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert html_extract.extracted(df.limit(0)).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, odd, none, judged, items, tmp_path, name, stage):
    for table, df in (("labels", judged), ("benchmark", items)):
        df.write.parquet(f"{tmp_path}/{table}.parquet")
    last = name == corpus_pipeline.STAGES[-1][0]
    for docs in (odd, none):
        docs.write.mode("overwrite").parquet(f"{tmp_path}/in.parquet")
        out = stage(spark, spark.read.parquet(f"{tmp_path}/in.parquet"), str(tmp_path))
        assert last or out.columns == docs.columns
        rows = out.collect()
        assert len(rows) <= (2 * docs.count() if last else docs.count())
        if name == "near_duplicates" and docs is odd:
            kept = [r.doc_id for r in rows]
            assert kept.count(4) == 1 and kept.count(1) == 1 and 10 not in kept and 2 not in kept
        if name == "personal_data":
            assert len(rows) == docs.count()
            assert all((r.text is None) == (r.n_chars is None) for r in rows)


def test_spelling(odd, none):
    assert spelling.grouped(odd).collect() == []  # no word of six letters is met five times
    assert spelling.grouped(none).collect() == []


def test_mix_keeps_a_column_named_copy(odd):
    got = mixing.mixed(odd)
    assert got.columns == [*odd.columns, "_copy"]
    assert {r["copy"] for r in got.select("copy").collect()} == {"own copy"}
    assert mixing.mixed(odd.drop("copy")).columns[-1] == "copy"
