from __future__ import annotations

import pytest

from litsieve import session
from litsieve.schema import REF
from litsieve.sources.samples import write_samples
from litsieve.streaming import preprocess as stream


class FakeSession:
    """A cluster session as far as the scratch folder goes."""

    def __init__(self, named, master="spark://host:7077", current=None):
        self.settings = {"spark.checkpoint.dir": named} if named else {}
        self.conf = self.sparkContext = self
        self.master, self.current = master, current

    def get(self, key, default):
        return self.settings.get(key, default)

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


def test_shared_folder_is_the_named_one():
    cluster = FakeSession("hdfs://shared/")
    assert session.shared_dir(cluster) == cluster.current == "hdfs://shared/"
    one, two = (session.scratch_path(cluster, "x") for _ in range(2))
    assert one != two and one.startswith("hdfs://shared/x-")
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession(None))
    assert session.shared_dir(FakeSession(None, "local[2]")).startswith("/")


def test_spread_only_adds_tasks_where_there_are_few(spark):
    many = spark.range(0, 100, 1, 64)
    assert session.spread(many, "id") is many
    assert session.spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == 8


def test_stream_picks_up_new_files(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def arrive(key, mode):
        df = spark.createDataFrame([(key, "T", "A", "see www.x.org Figure 1")],
                                   "ID string, title string, abstract string, extractedText string")
        write_samples(df, inbox, REF, mode=mode)
        job = stream.start(stream.stream_samples(spark, inbox, REF), ["removeURLs"], out, state, once=True)
        job.awaitTermination()

    arrive("1", "errorifexists")
    arrive("2", "append")
    rows = spark.read.parquet(out).orderBy("ID").collect()
    assert [(r.ID, r.extractedText) for r in rows] == [("1", "see  figure 1"), ("2", "see  figure 1")]


def test_stream_scores_samples(spark, tmp_path):
    from pyspark.sql import functions as F

    from litsieve.operators import features, learning
    from litsieve.operators.preprocess import document

    def words(df):
        return features.with_words(df.withColumn("text", document(df))).drop("text")

    rows = [(str(i), "T", "A", "mice knock_out" if i % 2 else "patient clinic") for i in range(40)]
    samples = spark.createDataFrame(rows, "ID string, title string, abstract string, extractedText string")
    labelled = words(samples).withColumn("label", (F.col("ID").cast("int") % 2))
    model = learning.fit(labelled, "logistic", maxIter=10)
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    write_samples(samples, inbox, REF)
    stream.start(
        stream.stream_samples(spark, inbox, REF), ["removeURLs"], out, state,
        score=lambda df: learning.predict(model, words(df)).drop("words"), once=True,
    ).awaitTermination()
    got = {r.ID: r.pred_class for r in spark.read.parquet(out).collect()}
    assert got == {k: "keep" if int(k) % 2 else "discard" for k in got} and len(got) == 40
