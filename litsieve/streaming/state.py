"""What the stateful streams share."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import parquet
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery

from litsieve.sources.staged import open_store

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Keyed state with timers needs the disk-based store; memory holds a cache of it only."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)


_MARK = "_gives_changed_rows"


def gives_changed_rows(rows: DataFrame) -> DataFrame:
    """Marks a running aggregate for :func:`append`: the file sink takes none."""
    setattr(rows, _MARK, True)
    return rows


class ChangedRows:
    """Writes the rows that a batch changed, a parquet file per partition with rows.

    The first partition writes one without rows too, so that a folder can always be read. The file is named by batch and partition and put in place when it is whole: a batch that
    runs again replaces its own files.
    """

    ROWS = 4096

    def __init__(self, out: str, schema: pa.Schema):
        self.out, self.schema = out, schema

    def open(self, partition: int, batch: int) -> bool:
        self.store, folder = open_store(self.out)
        name = f"{batch:08d}-{partition:06d}.parquet"
        self.draft, self.target = f"{folder}/_draft-{name}", f"{folder}/{name}"
        self.rows: list[dict] = []
        self.file, self.first = None, partition == 0
        return True

    def process(self, row: Row) -> None:
        self.rows.append(row.asDict())
        if len(self.rows) >= self.ROWS:
            self._flush()

    def _flush(self) -> None:
        if self.file is None:
            self.store.create_dir(self.target.rsplit("/", 1)[0], recursive=True)
            self.file = parquet.ParquetWriter(self.draft, self.schema, filesystem=self.store)
        self.file.write_table(pa.Table.from_pylist(self.rows, self.schema))
        self.rows = []

    def close(self, error: Exception | None) -> None:
        if error is None and (self.rows or self.first):
            self._flush()
        if self.file is not None:
            self.file.close()
            if error is None:
                self.store.move(self.draft, self.target)


def append(rows: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append to a parquet folder; ``once`` stops after the files that are there.

    A stream with timers has no such end: it must be stopped. Of a running aggregate, which
    has no rows that are final, those that a batch changed are appended.
    """

    def start(writer):
        writer = writer.option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()

    if getattr(rows, _MARK, False):
        changed = ChangedRows(out, to_arrow_schema(rows.schema))
        return start(rows.writeStream.outputMode("update").foreach(changed))
    return start(rows.writeStream.format("parquet").outputMode("append").option("path", out))
