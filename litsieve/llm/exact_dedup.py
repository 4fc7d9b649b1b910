"""Exact duplicates by counting quotient filters and byte verification.

Texts are equal if they are identical once every run of white space is one blank. Each task
counts the fingerprints of its rows in counting quotient filters, one per shard (the leading
bits of the fingerprint); a copied text is one entry with a count, however often a task meets
it. The filters of a shard meet in one task and are merged by their sorted remainders. Shards
are as many as keep one at ``SHARD`` rows in expectation, so a task's memory does not grow.

Fingerprints with a count of one are done: no other text has them. Rows with any other one
go on, with their whole text, to an aggregate that groups by the bytes themselves and is
combined before its shuffle, so that a task sends each repeated text once. The groups are
addressed by fingerprint and SHA-256; an address that two different texts share fails the job.

Null texts count as empty and equal texts of white space only to a single blank, not to the
empty text. Of rows with the same least doc_id the first stays; rows without a doc_id come
last, and a group of nothing else keeps one of them, with a NULL keep_id. Repeated rows are
copies of each other. Texts of any length are read whole; an empty table gives no rows; other
columns, whatever their names, are ignored by :func:`classes` and kept by :func:`keep_first`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litsieve import session
from litsieve.llm import common
from litsieve.llm.quotient_filter import QuotientFilter, counted, merged

BITS = 64
#: Fingerprints that a task buffers, and that a shard holds in expectation.
SHARD = 1 << 20

_Batches = Iterator[pa.RecordBatch]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), common.BLANKS, " ")


def fingerprint(norm: Column, bits: int = BITS) -> Column:
    return F.shiftrightunsigned(F.xxhash64(norm), 64 - bits) if bits < 64 else F.xxhash64(norm)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _building(bits: int, shard_bits: int) -> Callable[[_Batches], _Batches]:
    """Filters (shard, filter) of the fingerprints of one task."""
    low = bits - shard_bits

    def filters(values: np.ndarray) -> pa.RecordBatch:
        values, counts = counted(values, np.ones(len(values), np.int64))
        shards = (values >> np.uint64(low)).astype(np.int64) if shard_bits else np.zeros(len(values), np.int64)
        values = values & np.uint64((1 << low) - 1)
        names, first = np.unique(shards, return_index=True)
        cuts = np.append(first, len(values))
        packed = [
            QuotientFilter.build(values[a:b], counts[a:b], low).to_bytes() for a, b in zip(cuts[:-1], cuts[1:])
        ]
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(packed, pa.binary())], ["shard", "filter"])

    def build(batches: _Batches) -> _Batches:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(_numbers(batch.column(0)).copy())
            if sum(map(len, held)) >= SHARD:
                yield filters(np.concatenate(held))
                held = []
        if held:
            yield filters(np.concatenate(held))

    return build


def _merging(bits: int, shard_bits: int) -> Callable[[_Batches], _Batches]:
    """(fp, n) of the fingerprints met more than once, from filters sorted by shard."""
    low = bits - shard_bits

    def repeated(shard: int, whole: QuotientFilter) -> pa.RecordBatch:
        values, counts = whole.items()
        values, counts = values[counts > 1], counts[counts > 1]
        values = values | np.uint64(shard << low if shard else 0)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["fp", "n"])

    def merge(batches: _Batches) -> _Batches:
        now, whole, waiting, size = None, merged([], low), [], 0
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if shard != now:
                    if now is not None:
                        yield repeated(now, merged([whole, *waiting], low))
                    now, whole, waiting, size = shard, merged([], low), [], 0
                waiting.append(QuotientFilter.from_bytes(data.as_py()))
                size += len(waiting[-1].slots)
                if size > max(len(whole.slots), SHARD // 4):
                    whole, waiting, size = merged([whole, *waiting], low), [], 0
        if now is not None:
            yield repeated(now, merged([whole, *waiting], low))

    return merge


def repeated_fingerprints(prints: DataFrame, bits: int = BITS, shard: int = SHARD) -> DataFrame:
    """(fp, n) of every fingerprint (``fp``) that more than one row has."""
    rows = prints.count()
    shard_bits = min(max((rows - 1) // shard, 0).bit_length(), bits - 8)
    filters = prints.select("fp").mapInArrow(_building(bits, shard_bits), "shard bigint, filter binary")
    filters = filters.repartition("shard").sortWithinPartitions("shard")
    return filters.mapInArrow(_merging(bits, shard_bits), "fp bigint, n bigint")


def _grouped(docs: DataFrame, bits: int, shard: int, *keep: Column) -> DataFrame:
    """Every row (doc_id, digest, ``keep``) with best (place of the row that stays) and size."""
    norm = normalised(common.field("text"))
    rows = docs.select(
        common.field("doc_id").alias("doc_id"), fingerprint(norm, bits).alias("fp"),
        F.unhex(F.sha2(norm, 256)).alias("digest"), F.monotonically_increasing_id().alias("row"), *keep,
    )
    rows = session.materialise(rows, "prints")
    # stored, so that Spark knows its size before it chooses the joins
    several = session.materialise(repeated_fingerprints(rows, bits, shard).select("fp"), "repeated")

    texts = docs.select(norm.alias("norm")).withColumn("fp", fingerprint(F.col("norm"), bits))
    equal = texts.join(several, "fp", "left_semi").groupBy("fp", "norm").agg(F.count("*").alias("size"))
    equal = equal.select("fp", F.unhex(F.sha2("norm", 256)).alias("digest"), "size")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    best = rows.join(several, "fp", "left_semi").groupBy("fp", "digest").agg(F.min(place).alias("best"))
    alone = F.when(F.count("*") == 1, F.first("size")).otherwise(
        F.raise_error(F.lit("two different texts share fingerprint and digest"))
    )
    groups = equal.groupBy("fp", "digest").agg(alone.alias("size")).join(best, ["fp", "digest"])
    groups = session.materialise(groups.filter("size > 1"), "groups")
    return rows.join(groups, ["fp", "digest"], "left")


def classes(docs: DataFrame, bits: int = BITS, shard: int = SHARD) -> DataFrame:
    """Per document row: doc_id, keep_id, group_size, kept, text_sha256."""
    stays = F.col("best").isNull() | (F.col("best.row") == F.col("row"))
    return _grouped(docs, bits, shard).select(
        "doc_id",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
        stays.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, bits: int = BITS, shard: int = SHARD) -> DataFrame:
    """The documents that stay, with all their columns; dropped ones are named by row."""
    rows = common.packed(docs).withColumns(
        {"doc_id": F.col("doc").getField("doc_id"), "text": F.col("doc").getField("text")}
    )
    grouped = _grouped(rows, bits, shard, F.col("doc"))
    return common.unpacked(grouped.filter("best is null or best.row = row"), docs)
