"""Sample files as a data source, byte for byte as the published ones.

A record ends in ``;;`` and a line break; the first two records are the meta data and the names
of the fields. A set is written as numbered parts whose concatenation is one sample file: part 0
holds meta data and header, written by the commit, and every task adds a part.

Reading cuts files into ranges of bytes. A run of two or more semicolons ends a record, and an
odd one gives its first semicolon to the text, so that a text may end in one. A range owns the
records that follow a run beginning in it; a run that began before a range is not its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow.fs import FileSelector, FileType
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSourceReader, InputPartition

from litsieve.schema import RECORD_END, SampleType, sample_type
from litsieve.sources.samples import META_MARK, parse_records, to_record
from litsieve.sources.staged import StagedSource, StagedWriter, Staging, Written, open_store

SPLIT_BYTES = 64 << 20
_CHUNK = 4 << 20
_ROWS = 1000
_RUN = re.compile(rb";{2,}")
_END = RECORD_END + "\n"


def _runs(file: BinaryIO, at: int, chunk: int) -> Iterator[tuple[int, int, bytes]]:
    """(begin, end, bytes since the run before) of every run from ``at`` on, and of the end."""
    held, base, scan, over = bytearray(), at, 0, False
    file.seek(at)
    while True:
        run = _RUN.search(held, scan)
        if run and (over or run.end() < len(held)):
            yield base + run.start(), base + run.end(), bytes(held[: run.start()])
            base, scan = base + run.end(), 0
            del held[: run.end()]
        elif over:
            yield base + len(held), base + len(held), bytes(held)
            return
        else:
            scan = run.start() if run else max(len(held) - 1, 0)
            data = file.read(chunk)
            over = not data
            held += data


def range_records(file: BinaryIO, start: int, end: int, chunk: int = _CHUNK) -> Iterator[bytes]:
    """The records that the range of bytes owns, blank ones as well."""
    at, owned = start, start == 0
    if start:
        file.seek(start - 1)
        if file.read(1) == b";":
            while file.read(1) == b";":
                at += 1
    for begin, stop, text in _runs(file, at, chunk):
        if owned:
            yield text + b";" * ((stop - begin) % 2)
        owned = start <= begin < end
        if begin >= end:
            return


@dataclass
class FileRange(InputPartition):
    path: str
    start: int
    end: int


class _Reader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))

    def partitions(self) -> list[FileRange]:
        store, path = open_store(self.path)
        info = store.get_file_info(path)
        found = [info] if info.type == FileType.File else store.get_file_info(FileSelector(path, recursive=True))
        files = sorted(
            (f for f in found if f.type == FileType.File and not f.base_name.startswith(("_", "."))),
            key=lambda f: f.path,
        )
        return [
            FileRange(f.path, at, min(at + self.split, f.size)) for f in files for at in range(0, f.size, self.split)
        ]

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.path)
        held: list[str] = []
        with store.open_input_file(partition.path) as file:
            for record in range_records(file, partition.start, partition.end):
                if record.strip():
                    held.append(record.decode("utf-8").lstrip())
                if len(held) >= _ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(held)], ["value"])
                    held = []
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])


class _Writer(StagedWriter):
    def write_files(self, batches: Iterator[pa.RecordBatch], staging: Staging) -> tuple[int, int]:
        n = 0

        def records() -> Iterator[bytes]:
            nonlocal n
            for batch in batches:
                n += batch.num_rows
                yield "".join(r + _END for r in batch.column("value").to_pylist()).encode()

        staging.write(f"part-{staging.partition + 1:06d}", records())
        return n, 1

    def first_files(self, messages: list[Written]) -> Iterator[tuple[str, bytes]]:
        count = sum(m.rows for m in messages)
        yield "part-000000", first_part(self.options["meta"], self.options["header"], count)


class SampleFiles(StagedSource):
    """Records as one column ``value``; option ``splitBytes`` bounds a task's range."""

    writer_class = _Writer

    @classmethod
    def name(cls) -> str:
        return "sample_files"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def _meta_text(meta: Mapping[str, str]) -> str:
    """``key=value`` items; a blank within a value would end it."""
    return " ".join(f"{k}={re.sub(r'[;|]|[^!-~]', '_', str(v))}" for k, v in meta.items())


def first_part(meta: str, header: str, count: int) -> bytes:
    return f"{META_MARK} {meta} count={count}{_END}{header}{_END}".encode()


def _record(kind: SampleType) -> Column:
    """A record that can be told from its neighbours, or an error."""
    record = to_record(kind)
    bad = F.contains(record, F.lit(RECORD_END)) | F.startswith(record, F.lit(";"))
    message = F.concat(F.lit("record holds a record end: "), F.substring(record, 1, 100))
    return F.when(bad, F.raise_error(message)).otherwise(record)


def write_sample_file(df: DataFrame, path: str, kind: SampleType, meta: Mapping[str, str] | None = None,
                      overwrite: bool = False) -> None:
    """The samples in the order of their partitions; sort them first if the order matters."""
    df.sparkSession.dataSource.register(SampleFiles)
    items = {"sampleObjType": kind.name, **(meta or {})}
    rows = df.select(_record(kind).alias("value"))
    writer = rows.write.format("sample_files").option("meta", _meta_text(items)).option("header", kind.header)
    writer.mode("overwrite" if overwrite else "append").save(path)


def read_sample_records(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    spark.dataSource.register(SampleFiles)
    return spark.read.format("sample_files").option("splitBytes", split_bytes).load(path)


def read_sample_meta(spark: SparkSession, path: str) -> dict[str, str]:
    """The items of the first meta record."""
    row = read_sample_records(spark, path).filter(F.col("value").startswith(META_MARK)).first()
    return dict(i.split("=", 1) for i in row.value.split() if "=" in i) if row else {}


def read_sample_file(spark: SparkSession, path: str, kind: SampleType | None = None,
                     split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The samples; their type is taken from the meta data unless given."""
    if kind is None:
        kind = sample_type(read_sample_meta(spark, path)["sampleObjType"])
    return parse_records(read_sample_records(spark, path, split_bytes), kind)


def stamp_sample_file(spark: SparkSession, path: str, meta: Mapping[str, str]) -> None:
    """Replace the meta data; records are not touched and the time of change is kept."""
    old = read_sample_meta(spark, path)
    kind = sample_type(meta.get("sampleObjType", old.get("sampleObjType")))
    items = {"sampleObjType": kind.name, **{k: v for k, v in meta.items() if k != "sampleObjType"}}
    context = spark.sparkContext
    file = context._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/part-000000")
    hadoop = file.getFileSystem(context._jsc.hadoopConfiguration())
    changed = hadoop.getFileStatus(file).getModificationTime()
    out = hadoop.create(file, True)
    out.write(bytearray(first_part(_meta_text(items), kind.header, int(old.get("count", 0)))))
    out.close()
    hadoop.setTimes(file, changed, -1)
