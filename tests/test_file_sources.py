"""Staged writers and the sample-file source."""

from __future__ import annotations

import io
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litsieve import schema
from litsieve.sources import article_files, ordered_tsv, sample_files

TEXT = st.text("ab;|\n ", max_size=12).filter(lambda t: ";;" not in t and not t.startswith(";") and t == t.lstrip())


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=8), st.integers(1, 9), st.integers(1, 7), st.booleans())
def test_ranges_share_out_all_records(texts, split, chunk, ended):
    data = "".join(t + ";;\n" for t in texts).encode()
    if not ended:
        data = data[:-3]
    got = []
    for start in range(0, len(data), split):
        got += sample_files.range_records(io.BytesIO(data), start, min(start + split, len(data)), chunk)
    # blank records drop out; a text that was cut off in its end is the last one as it stands
    want = [t for t in texts if t.strip()]
    assert [g.decode().lstrip() for g in got if g.strip()] == want


def _samples(spark, n=200):
    rnd = random.Random(2)
    ends = ["", ";", " ;", ".\n", "\n\nfigure;"]
    rows = [(str(i), f"T {i};" if i % 9 == 0 else f"T {i}", "", f"Words {i} ä" + rnd.choice(ends)) for i in range(n)]
    return spark.createDataFrame(rows, schema.REF.struct), rows


def _whole(path):
    parts = sorted(f for f in os.listdir(path) if f.startswith("part"))
    return b"".join(open(f"{path}/{f}", "rb").read() for f in parts)


def test_sample_file_byte_for_byte(spark, tmp_path):
    df, rows = _samples(spark)
    path = str(tmp_path / "set")
    sample_files.write_sample_file(df.coalesce(1).repartitionByRange(5, F.col("ID").cast("int")), path, schema.REF, {"host": "h 1", "db": "x"})
    want = f"#meta sampleObjType={schema.REF.name} host=h_1 db=x count=200;;\n{schema.REF.header};;\n"
    want += "".join("|".join(r) + ";;\n" for r in sorted(rows, key=lambda r: int(r[0])))
    assert _whole(path) == want.encode()
    for split in (64 << 20, 97, 7):
        back = sample_files.read_sample_file(spark, path, split_bytes=split)
        assert sorted(map(tuple, back.collect())) == sorted(rows)
    single = tmp_path / "one"
    single.write_bytes(want.encode())
    assert sorted(map(tuple, sample_files.read_sample_file(spark, str(single), schema.REF, 50).collect())) == sorted(rows)
    again = str(tmp_path / "again")
    sample_files.write_sample_file(
        sample_files.read_sample_file(spark, path).repartitionByRange(3, F.col("ID").cast("int")), again, schema.REF,
        {"host": "h 1", "db": "x"},
    )
    assert _whole(again) == want.encode()


def test_stamp_keeps_the_time_of_change(spark, tmp_path):
    df, rows = _samples(spark, 20)
    path = str(tmp_path / "set")
    sample_files.write_sample_file(df, path, schema.REF)
    os.utime(f"{path}/part-000000", (1_500_000_000, 1_500_000_000))
    sample_files.stamp_sample_file(spark, path, {"date": "09/18/2019"})
    assert os.stat(f"{path}/part-000000").st_mtime == 1_500_000_000
    meta = sample_files.read_sample_meta(spark, path)
    assert meta == {"sampleObjType": schema.REF.name, "date": "09/18/2019", "count": "20"}
    assert sorted(map(tuple, sample_files.read_sample_file(spark, path).collect())) == sorted(rows)


def test_empty_set_and_bad_records(spark, tmp_path):
    df, _ = _samples(spark, 5)
    path = str(tmp_path / "none")
    sample_files.write_sample_file(df.limit(0), path, schema.REF)
    assert sample_files.read_sample_file(spark, path).count() == 0
    bad = df.withColumn("title", F.lit("a;;b"))
    with pytest.raises(Exception, match="record end"):
        sample_files.write_sample_file(bad, str(tmp_path / "bad"), schema.REF)
    assert not (tmp_path / "bad").exists()
    with pytest.raises(Exception, match="exists"):
        sample_files.write_sample_file(df, path, schema.REF)
    sample_files.write_sample_file(df, path, schema.REF, overwrite=True)
    assert sample_files.read_sample_file(spark, path).count() == 5


def test_one_file_per_article(spark, tmp_path):
    rows = [(i, f"J of {i % 3}", f"text {i}\n\nmore") for i in range(60)]
    rows = [(str(i), j, t) for i, j, t in rows]
    rows += [("100", None, "x"), ("101", "J", None), ("a/b", "", ""), ("..", "J", "dots"), ("104", "J+1 %2F", "plus")]
    df = spark.createDataFrame(rows, "pmcid string, journal string, text string")
    path = str(tmp_path / "texts")
    article_files.write_article_files(df.repartition(7), path, "pmcid", "text")
    found = {os.path.relpath(os.path.join(d, f), path): open(os.path.join(d, f)).read()
             for d, _, fs in os.walk(path) for f in fs if f != "_SUCCESS"}
    want = {f"J_of_{i % 3}/{i}.txt": f"text {i}\n\nmore" for i in range(60)}
    want |= {"-/100.txt": "x", "-/a_b.txt": "", "J/-...txt": "dots", "J+1_%2F/104.txt": "plus"}
    assert found == want
    back = article_files.read_article_files(spark, path).collect()
    assert {f"{r.journal}/{r.article}.txt": r.text for r in back} == {k: v for k, v in want.items() if v}


def test_two_articles_of_one_name_fail(spark, tmp_path):
    df = spark.createDataFrame([(1, "J", "a"), (1, "J", "b")], "pmcid long, journal string, text string")
    with pytest.raises(Exception, match="two articles"):
        article_files.write_article_files(df, str(tmp_path / "texts"), "pmcid", "text")
    assert not (tmp_path / "texts").exists()


def test_a_task_that_fails_half_way_writes_no_file_twice(tmp_path):
    """The second attempt replaces what the first one had put in place."""
    import pyarrow as pa

    class Context:
        def __init__(self, attempt):
            self.attempt = attempt

        def partitionId(self):
            return 0

        def taskAttemptId(self):
            return self.attempt

    names = pa.RecordBatch.from_pydict({"name": ["J/1.txt", "J/2.txt"], "content": ["a", "b"]})

    def breaking():
        yield names
        raise RuntimeError("lost")

    from unittest.mock import patch

    from litsieve.sources import staged

    writer = article_files._Writer({"path": str(tmp_path / "out")}, False)
    with patch.object(staged.TaskContext, "get", lambda: Context(1)), pytest.raises(RuntimeError):
        writer.write(breaking())
    with patch.object(staged.TaskContext, "get", lambda: Context(2)):
        message = writer.write(iter([names]))
    writer.commit([message])
    files = sorted(os.path.relpath(os.path.join(d, f), tmp_path) for d, _, fs in os.walk(tmp_path) for f in fs)
    assert files == ["out/J/1.txt", "out/J/2.txt", "out/_SUCCESS"]


@pytest.mark.parametrize("n", [0, 500])
def test_ordered_tsv(spark, tmp_path, n):
    rnd = random.Random(3)
    rows = [(rnd.randrange(10**6), f"J {rnd.randrange(40)}", None if i % 7 == 0 else f"a\tb{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "pubmed long, journal string, note string").repartition(6)
    path = str(tmp_path / "ids")
    ordered_tsv.write_ordered_tsv(df, path, ["journal", "pubmed", "note"])
    want = sorted(rows, key=lambda r: (r[1], r[0], r[2] is not None, r[2] or ""))
    lines = ["pubmed\tjournal\tnote"] + [f"{a}\t{b}\t{(c or '').replace(chr(9), ' ')}" for a, b, c in want]
    assert _whole(path).decode() == "".join(line + "\n" for line in lines)
    if n:
        back = ordered_tsv.read_ordered_tsv(spark, path).orderBy("line").collect()
        assert ["\t".join([r.pubmed, r.journal, r.note]) for r in back] == lines[1:]


def test_article_files_are_read_in_few_tasks(spark, tmp_path):
    """A scan had a task for every few dozen files."""
    path = str(tmp_path / "texts")
    df = spark.range(0, 600, 1, 4).select(F.lit("J").alias("journal"), "id", F.lit("text").alias("text"))
    article_files.write_article_files(df, path, "id", "text")
    back = article_files.read_article_files(spark, path)
    assert back.rdd.getNumPartitions() <= 8
    assert back.count() == 600 and back.select("article").distinct().count() == 600
