"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    # date literals and formatted dates must not depend on the host
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where the join feeds an aggregate on that key
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the jobs rely on."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="litsieve-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write rows that many jobs will read to the shared folder and read them back.

    Later jobs neither repeat nor plan what led to them, and a lost executor
    costs no more than reading a file again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Enough tasks for a CPU-bound step over one small file.

    A single file, often of one row group, may have fewer tasks than there are cores; it
    is dealt out by its key. A table of several files is never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) > 1 or df.rdd.getNumPartitions() > cores:
        return df
    return df.repartition(cores, *keys)


#: Rows of one task of a keyed step, about.
DEALT_ROWS = 1 << 18


def deal(df: DataFrame, *keys: str, rows: int = DEALT_ROWS) -> DataFrame:
    """The rows of a table that is grouped by its keys next, in tasks of about ``rows`` rows.

    That grouping shuffles them anyway. The number of tasks follows the table, so that what
    one of them sorts or hashes, there and in later steps on the same keys, does not grow
    with it. The rows of a stored table are counted from its file footers.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // rows)), *keys)
