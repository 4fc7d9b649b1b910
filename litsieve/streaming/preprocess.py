"""Preprocessing new sample records as they arrive.

Only row-local steps run here, so the stream keeps no state; text assembly and
everything that counts belongs to the batch jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from litsieve.operators.preprocess import preprocess
from litsieve.schema import RECORD_END, SampleType
from litsieve.sources.samples import parse_records


def stream_samples(spark: SparkSession, path: str, kind: SampleType,
                   files_per_trigger: int = 1000) -> DataFrame:
    """Samples of files that appear in a folder."""
    records = (
        spark.readStream.option("lineSep", RECORD_END)
        .option("maxFilesPerTrigger", files_per_trigger)
        .text(path)
    )
    return parse_records(records, kind)


def start(samples: DataFrame, steps: Iterable[str], out: str, checkpoint: str,
          score: Callable[[DataFrame], DataFrame] | None = None,
          once: bool = False) -> StreamingQuery:
    """Preprocess, score if asked to, and append to a parquet folder.

    ``score`` is a row-local step such as applying a model; ``once`` stops after
    the files that are there.
    """
    rows = preprocess(samples, steps)
    writer = (
        (score(rows) if score else rows)
        .writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
