"""One tab-separated table in order, with one header, as numbered parts.

The rows are range-partitioned by the sort, each task writes the part of its number, and the
header is a part of its own before them. ``cat`` of the parts in the order of their names is
the table; no row passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyarrow import RecordBatch
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litsieve.sources.staged import StagedSource, StagedWriter, Staging, Written


class _Writer(StagedWriter):
    def write_files(self, batches: Iterator[RecordBatch], staging: Staging) -> tuple[int, int]:
        n = 0

        def lines() -> Iterator[bytes]:
            nonlocal n
            for batch in batches:
                if batch.num_rows:
                    n += batch.num_rows
                    yield "".join(line + "\n" for line in batch.column("line").to_pylist()).encode()

        staging.write(f"part-{staging.partition + 1:06d}.tsv", lines())
        return n, 1

    def first_files(self, messages: list[Written]) -> Iterator[tuple[str, bytes]]:
        yield "part-000000.tsv", (self.options["header"] + "\n").encode()


class OrderedTsv(StagedSource):
    writer_class = _Writer

    @classmethod
    def name(cls) -> str:
        return "ordered_tsv"


def write_ordered_tsv(df: DataFrame, path: str, order: list[str | Column], overwrite: bool = False) -> None:
    """All columns of ``df`` in the given order of rows; tabs and line breaks become blanks."""
    df.sparkSession.dataSource.register(OrderedTsv)
    fields = [F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\\t\\n\\r]", " ") for c in df.columns]
    # one column carries the line through the sort's shuffle besides its keys
    rows = df.orderBy(*order).select(F.concat_ws("\t", *fields).alias("line"))
    rows.write.format("ordered_tsv").option("header", "\t".join(df.columns)).mode(
        "overwrite" if overwrite else "append"
    ).save(path)


def read_ordered_tsv(spark: SparkSession, path: str) -> DataFrame:
    """The table's columns as strings, and ``line``: (part, place in it) to order by."""
    lines = spark.read.option("wholetext", "false").text(path, pathGlobFilter="part-*.tsv")
    part = F.regexp_extract(F.col("_metadata.file_path"), r"part-(\d+)\.tsv$", 1).cast("int")
    lines = lines.select(
        "value", part.alias("part"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
    )
    names = lines.filter("part = 0").first().value.split("\t")
    fields = F.split("value", "\t", -1)
    return lines.filter("part > 0").select(
        F.struct("part", "block", "n").alias("line"), *[fields[i].alias(c) for i, c in enumerate(names)]
    )
