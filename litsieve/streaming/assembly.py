"""Article texts from parts that keep arriving.

The state of an article is the list of its parts so far. A text is given out once no part has
come for a while (``quiet``), and again, under the next version, when a late part comes. The
last version of every article is what the batch job makes of the same parts. With ``retain``
the parts of an article are forgotten when nothing has come for that long; a part that comes
even later is given out by itself and marked as not complete, for the batch job to mend.

Without either, no timers are needed and the parts so far are the state of a streaming aggregate.

Articles are the keys of the state store, so the state is spread over the tasks and bounded
per task by the parts of one article in memory; a restart goes on from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from litsieve.operators.texts import PART_ORDER, ordered_text, part_rank
from litsieve.streaming.state import gives_changed_rows, keep_state_on_disk

_OUT = "refs_key {}, ext_text string, version bigint, n_parts bigint, complete boolean"


class TextAssembler(StatefulProcessor):
    """Parts of an article in, its text out. Times in milliseconds."""

    def __init__(self, quiet: int = 0, retain: int | None = None):
        self.quiet, self.retain = quiet, retain

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getListState("parts", "rank int, part_no bigint, text_part string")
        # version given out last, whether parts came since, whether parts were forgotten
        self.given = handle.getValueState("given", "version bigint, waiting boolean, forgotten boolean")

    def _status(self) -> tuple[int, bool, bool]:
        return tuple(self.given.get()) if self.given.exists() else (0, False, False)

    def _wake(self, at: int) -> None:
        """One timer per article: the last one counts."""
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at)

    def _text(self, key: Any) -> Row:
        version, _, forgotten = self._status()
        # missing numbers first and texts by their bytes, as the batch job sorts them
        parts = sorted(self.parts.get(), key=lambda p: (p[0], p[1] is not None, p[1] or 0, p[2].encode()))
        self.given.update((version + 1, False, forgotten))
        text = "".join(p[2] for p in parts)
        return Row(refs_key=key[0], ext_text=text, version=version + 1, n_parts=len(parts), complete=not forgotten)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        self.parts.appendList([(r["rank"], r["part_no"], r["text_part"]) for r in rows])
        version, _, forgotten = self._status()
        if self.quiet > 0:
            self.given.update((version, True, forgotten))
            self._wake(timerValues.getCurrentProcessingTimeInMs() + self.quiet)
        else:
            yield self._text(key)
            if self.retain is not None:
                self._wake(timerValues.getCurrentProcessingTimeInMs() + self.retain)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        version, waiting, _ = self._status()
        if waiting:
            yield self._text(key)
            if self.retain is not None:
                self._wake(timerValues.getCurrentProcessingTimeInMs() + self.retain)
        elif self.retain is not None:
            self.parts.clear()
            self.given.update((version, False, True))


def stream_parts(spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int = 1000) -> DataFrame:
    """Parts (refs_key, part_no, text_type, text_part) of files that appear in a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def assemble_stream(parts: DataFrame, order: tuple[str, ...] = PART_ORDER, quiet: int = 0,
                    retain: int | None = None) -> DataFrame:
    """(refs_key, ext_text, version, n_parts, complete) of the articles whose parts arrive.

    Without ``quiet`` and ``retain`` a text is given out with every batch that has a part of
    it, no timers are kept, and the stream can be run for the files that are there.
    """
    keep_state_on_disk(parts.sparkSession)
    if not quiet and retain is None:
        return _aggregated(parts, order)
    rows = parts.filter(F.col("text_part").isNotNull()).select(
        "refs_key", part_rank(F.col("text_type"), order).cast("int").alias("rank"),
        F.col("part_no").cast("bigint").alias("part_no"), "text_part",
    )
    out = _OUT.format(parts.schema["refs_key"].dataType.simpleString())
    return rows.groupBy("refs_key").transformWithState(
        statefulProcessor=TextAssembler(quiet, retain), outputStructType=out, outputMode="Append",
        timeMode="ProcessingTime",
    )


def _aggregated(parts: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """The articles that a batch has parts of; the version counts the batches that had some."""
    rows = parts.filter(F.col("text_part").isNotNull()).select(
        "refs_key", "text_type", F.col("part_no").cast("bigint").alias("part_no"), "text_part",
        # one value per batch, kept in the log of the stream
        F.current_timestamp().alias("_batch"),
    )
    given = rows.groupBy("refs_key").agg(
        ordered_text(order).alias("ext_text"),
        F.size(F.collect_set("_batch")).cast("bigint").alias("version"),
        F.count("*").alias("n_parts"),
    )
    return gives_changed_rows(given.withColumn("complete", F.lit(True)))


def latest_texts(given: DataFrame) -> DataFrame:
    """(refs_key, ext_text): the last version of every article given out so far."""
    rest = F.struct("version", "ext_text")
    last = given.groupBy("refs_key").agg(F.max(rest).alias("last"))
    return last.select("refs_key", F.col("last.ext_text").alias("ext_text"))
