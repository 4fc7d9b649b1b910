"""Presence vectors packed into blocks of rows, for learners that pass over them often.

Rows are numbered in the order of a digest of their content, so the number of a row, and with
it its block and every draw made by number, does not depend on how the table was partitioned.
A block is one row of a stored table: a lost executor costs a read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from litsieve.session import materialise

Batches = Iterator[pa.RecordBatch]

_SCHEMA = "block bigint, labels binary, weights binary, lengths binary, terms binary"


def numbered(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Add ``position``, from 0 on in the order of the keys. Stored.

    Rows are sorted in range partitions, where running numbers are consecutive; what is
    left to add up is one count per partition.
    """
    lined = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    lined = materialise(lined.withColumn("at", F.monotonically_increasing_id()), "numbered")
    lined = lined.withColumn("part", F.shiftright("at", 33))
    parts = lined.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # one row per partition
    parts = parts.withColumn("start", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    out = lined.join(parts.select("part", "first", "start"), "part")
    return out.withColumn("position", F.col("at") - F.col("first") + F.col("start")).drop(
        "at", "part", "first", "start"
    )


@dataclass(frozen=True)
class Rows:
    """Rows of presence vectors: ``terms`` of row i are those from starts[i] to starts[i + 1]."""

    block: int
    labels: np.ndarray
    weights: np.ndarray
    starts: np.ndarray
    terms: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def presence(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, terms) of ML vectors, sparse or dense: places of the values that are not zero."""
    kind, _, indices, values = vectors.flatten()
    if not (kind.to_numpy(zero_copy_only=False) == 0).all():
        dense = [
            np.flatnonzero(v) if i is None else np.array(i)[np.array(v) != 0]
            for i, v in zip(indices.to_pylist(), values.to_pylist())
        ]
        return np.array([len(d) for d in dense]), np.concatenate(dense).astype(np.int32)
    terms = indices.flatten().to_numpy(zero_copy_only=False)
    sizes = indices.value_lengths().to_numpy(zero_copy_only=False)
    there = values.flatten().to_numpy(zero_copy_only=False) != 0
    row = np.repeat(np.arange(len(sizes)), sizes)
    return np.bincount(row[there], minlength=len(sizes)), terms[there].astype(np.int32)


def _pack(batches: Batches) -> Batches:
    """One row per block from rows (block, features, label, weight) sorted by block."""

    def packed(block: int, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        columns = [np.concatenate(p).tobytes() for p in zip(*parts)]
        names = ["block", "labels", "weights", "lengths", "terms"]
        return pa.RecordBatch.from_arrays([pa.array([block]), *(pa.array([c]) for c in columns)], names)

    now, held = None, []
    for batch in batches:
        blocks = batch.column("block").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else blocks
        for start, end in zip(cuts, np.append(cuts[1:], len(blocks))):
            if held and blocks[start] != now:
                yield packed(now, held)
                held = []
            now = int(blocks[start])
            piece = batch.slice(start, end - start)
            lengths, terms = presence(piece.column("features"))
            label, weight = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight"))
            held.append((label.astype(np.float64), weight.astype(np.float64), lengths.astype(np.int32), terms))
    if held:
        yield packed(now, held)


def pack(df: DataFrame, size: int, features: str = "features", label: str = "label",
         weight: str | None = None, seed: int = 0) -> DataFrame:
    """Blocks of ``size`` rows each, the last one shorter. Stored.

    Labels are 0 or 1. Equal rows get neighbouring numbers, which of them comes first makes
    no difference.
    """
    rows = df.select(
        F.col(features).alias("features"), F.col(label).cast("double").alias("label"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"),
    )
    digest = F.xxhash64(F.lit(seed), "label", "features")
    rows = numbered(rows.withColumn("digest", digest), "digest", "label").drop("digest")
    rows = rows.withColumn("block", F.floor(F.col("position") / size)).repartition("block")
    rows = rows.sortWithinPartitions("block", "position").drop("position")
    return materialise(rows.mapInArrow(_pack, _SCHEMA), "blocks")


def unpack(batch: pa.RecordBatch) -> Iterator[Rows]:
    """The blocks of a batch of the stored table."""
    for row in batch.to_pylist():
        number = {k: np.frombuffer(row[k], t) for k, t in
                  (("labels", "<f8"), ("weights", "<f8"), ("lengths", "<i4"), ("terms", "<i4"))}
        yield Rows(row["block"], number["labels"], number["weights"], _starts(number["lengths"]), number["terms"])


def over_vectors(score: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Callable[[str], Column]:
    """A column function of ML vectors from a score of (starts, terms)."""

    @F.arrow_udf("double")
    def scores(vectors: pa.Array) -> pa.Array:
        lengths, terms = presence(vectors)
        return pa.array(score(_starts(lengths), terms), pa.float64())

    return scores
