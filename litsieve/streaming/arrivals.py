"""Outcomes of candidate articles that arrive in weekly files.

An entry that comes a second time, as when a file is delivered again, adds nothing. Entries are
remembered by Spark's own streaming deduplication, whose state is the arrivals alone; what the
database knows is joined to each batch.

With ``remember`` the state holds, per article number, whether the database knows it and which
entries have been seen. It starts from the known IDs, read once. Entries are remembered for that
many milliseconds, known IDs for good: the state grows with the database and the arrivals of
that span, not with the length of the stream. Each article number is a call of Python there.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from litsieve.operators.candidates import ARTICLE_TYPES, decide, key_of, with_outcome
from litsieve.streaming.state import keep_state_on_disk


class FirstArrivals(StatefulProcessor):
    """Gives out entries not seen before, with ``known``."""

    def __init__(self, columns: list[str], article_id: str, remember: int | None = None):
        self.columns, self.article_id, self.remember = columns, article_id, remember

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "known boolean")
        self.seen = handle.getMapState("seen", "id string", "seen boolean", self.remember)

    def handleInitialState(self, key: Any, initialState: Any, timerValues: Any) -> None:
        self.known.update((True,))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        known = self.known.exists()
        for row in rows:
            entry = (str(row[self.article_id]),)
            if not self.seen.containsKey(entry):
                self.seen.updateValue(entry, (True,))
                yield Row(**{c: row[c] for c in self.columns}, known=known)


def outcome_stream(articles: DataFrame, known: DataFrame, types: Mapping[str, bool] = ARTICLE_TYPES,
                   pmid: str = "pmid", kind: str = "type", article_id: str = "pmcid",
                   remember: int | None = None) -> DataFrame:
    """Arriving articles, each archive entry once, with ``outcome`` as the batch job has it."""
    keep_state_on_disk(articles.sparkSession)
    if remember is None:
        first = articles.withColumn("_key", key_of(pmid, article_id)).dropDuplicates(["_key", article_id])
        return with_outcome(first.drop("_key"), known, types, pmid, kind, article_id)
    # spread by their own ID where there is no PMID
    keyed = articles.withColumn("_key", key_of(pmid, article_id))
    start = known.filter(F.col(pmid).isNotNull()).select(F.col(pmid).cast("string").alias("_key")).distinct()
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in articles.schema)
    rows = keyed.groupBy("_key").transformWithState(
        statefulProcessor=FirstArrivals(articles.columns, article_id, remember),
        outputStructType=f"{fields}, known boolean", outputMode="Append",
        timeMode="ProcessingTime",
        initialState=start.groupBy("_key"),
    )
    return rows.withColumn("outcome", decide(F.col("known"), types, pmid, kind)).drop("known")
