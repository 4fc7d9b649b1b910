"""SimHash near-duplicates by anchor-point covering.

A fingerprint has a bit set if over half of its shingle hashes have it set. Two
fingerprints within three bits agree up to one bit in one of their halves. Each half,
32 bits, is covered by the anchors of a perfect Hamming code on 31 bits times the last
bit: every half is within one bit of an anchor (its home), so a half within one bit of
another one is within two bits of that one's home. Every fingerprint is replicated to
all anchors within two bits of either half, and fingerprints are compared per anchor.

Copies are no cost: fingerprints are made distinct first, with a combine before the
shuffle. Anchors without a second fingerprint, or that are nobody's home, are dropped by
a join. An anchor with more than ``TILE`` fingerprints is cut into tiles of bounded size,
and every pair of tiles is compared by a task of its own. A comparison returns a spanning
forest of its links, never all pairs; components come from joins.

Null texts count as empty; texts without a word have fingerprint zero and link like any
other; repeated rows are each returned; a component of rows without IDs has a NULL ID.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litsieve import session
from litsieve.llm import common, graph

SHINGLE = 3
MOST_BITS = 3
SEED = 42
#: Fingerprints of one anchor that are compared in one piece, at most.
TILE = 4096
_CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one whole text, unsigned."""
    got = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only
    if not got:
        return 0
    if len(got) < words:
        shingles: list[bytes] = [b" ".join(got)]
    else:
        shingles = list(map(b" ".join, zip(*[got[k:] for k in range(words)])))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, words: int = SHINGLE) -> Column:
    """Fingerprint of a text as a signed number with the same bits."""

    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        got = np.array([fingerprint(t.as_py(), words) for t in texts], np.uint64)
        return pa.array(got.view(np.int64))

    return simhash(text)


# --- anchors

_POSITIONS = np.arange(1, 32, dtype=np.uint32)


def _syndromes(low: np.ndarray) -> np.ndarray:
    """Which of the 31 bits, counted from 1, is off the Hamming code; 0 for none."""
    out = np.zeros(len(low), np.uint32)
    for p in _POSITIONS:
        out ^= np.where(low >> (p - 1) & 1, p, 0).astype(np.uint32)
    return out


#: For each syndrome the masks that lead to a codeword one or two bits away.
_MASKS = [
    np.array(
        [1 << (s - 1)]
        + [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if i < (i ^ s)],
        np.uint32,
    )
    if s
    else np.zeros(1, np.uint32)
    for s in range(32)
]


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) of every anchor within two bits of a half of each fingerprint.

    An anchor is the codeword, its 32nd bit and, above that, which half it stands for.
    """
    rows, keys, homes = [], [], []
    for half in (0, 1):
        part = (prints >> np.uint64(32 * half)).astype(np.uint32)
        low, top = part & np.uint32(0x7FFFFFFF), part >> np.uint32(31)
        off = _syndromes(low)
        for s in range(32):
            at = np.flatnonzero(off == s)
            if not len(at):
                continue
            words = low[at][:, None] ^ _MASKS[s][None, :]
            nearest = words[:, :1]
            code = np.concatenate([words, nearest], axis=1).astype(np.int64)
            bit = np.concatenate(
                [np.repeat(top[at][:, None], words.shape[1], 1), 1 - top[at][:, None]], axis=1
            ).astype(np.int64)
            rows.append(np.repeat(at, code.shape[1]))
            keys.append((code | bit << 31 | half << 32).ravel())
            home = np.zeros(code.shape, bool)
            home[:, 0] = True
            homes.append(home.ravel())
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 8192):
            some = prints[at : at + 8192]
            rows, keys, homes = anchors(some.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(some[rows]), pa.array(homes)], ["anchor", "fp", "home"]
            )


# --- comparing


def spanning(prints: np.ndarray, most: int = MOST_BITS) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints, as pairs of positions."""
    edges: list[tuple[int, int]] = []
    left = np.arange(len(prints))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(prints[left] ^ prints[at]) <= most
            if near.any():
                found, left = left[near], left[~near]
                edges += [(int(at), int(x)) for x in found]
                queue += list(found)
    return edges


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted (anchor, lo, hi, fp) rows; a group may go on in the next batch."""
    names = ["anchor", "lo", "hi"]
    held: list[np.ndarray] | None = None

    def compared(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        ends = np.r_[starts[1:], len(prints)]
        a, b = [], []
        pairs = starts[ends - starts == 2]  # by far the most groups
        near = pairs[np.bitwise_count(prints[pairs] ^ prints[pairs + 1]) <= MOST_BITS]
        a.append(prints[near])
        b.append(prints[near + 1])
        for s, e in zip(starts, ends):
            if e - s > 2 and (edges := spanning(prints[s:e])):
                i, j = np.array(edges).T
                a.append(prints[s + i])
                b.append(prints[s + j])
        got = np.stack([np.concatenate(a), np.concatenate(b)], 1).view(np.int64)
        got = np.unique(got, axis=0)
        return pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names], 1)
        prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        if held is not None:
            keys, prints = np.concatenate([held[0], keys]), np.concatenate([held[1], prints])
        last = int(np.flatnonzero((keys != keys[-1]).any(axis=1)).max(initial=-1)) + 1
        held = [keys[last:].copy(), prints[last:].copy()]
        if last:
            yield compared(keys[:last], prints[:last])
    if held is not None:
        yield compared(*held)


def links(distinct: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, b): links among distinct fingerprints (fp) that join all that are linked.

    Spark sizes the replicated rows, some 31 to a fingerprint, by those they come from, so a
    table of few MB would have them broadcast; the join is always one of shuffled rows.
    """
    spread = distinct.select("fp").mapInArrow(_replicate, "anchor bigint, fp bigint, home boolean")
    shared = spread.groupBy("anchor").agg(F.count("*").alias("n"), F.max("home").alias("home"))
    shared = shared.filter("n > 1 and home").select(
        "anchor", F.ceil(F.col("n") / tile).cast("bigint").alias("tiles")
    )
    rows = spread.select("anchor", "fp").hint("merge").join(shared, "anchor")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    rows = rows.select(
        "anchor", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp"
    )
    keys = ["anchor", "lo", "hi"]
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "fp")
    return rows.mapInArrow(_compare, "a bigint, b bigint").distinct()


def rooted(distinct: DataFrame, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints (fp and more) with ``root``, the least one reachable."""
    roots = graph.components(links(distinct, tile)).withColumnRenamed("a", "fp")
    return distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def linked(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """Per document row: doc_id, fingerprint (hex) and component_id."""
    prints = session.materialise(
        docs.select(
            common.field("doc_id").alias("doc_id"), fingerprints(common.text_of(), words).alias("fp")
        ),
        "simhash",
    )
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    whole = rooted(distinct)
    least = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = whole.select("fp", "root").join(least, "root").select("fp", "component_id")
    # copies make the stored rows much smaller than they are in memory: not broadcast either
    out = prints.hint("merge").join(classes, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """One document of each component, that with the least doc_id, with all its columns.

    Of repeated rows one stays; a component of rows without IDs keeps one of them.
    """
    rows = common.packed(docs).withColumn(
        "fp", fingerprints(F.coalesce(F.col("doc").getField("text"), F.lit("")), words)
    )
    rows = session.materialise(
        rows.select("doc", "fp", F.monotonically_increasing_id().alias("row")), "simhash"
    )
    ident = F.col("doc").getField("doc_id")
    place = F.struct(ident.isNull().alias("nameless"), ident.alias("doc_id"), "row")
    distinct = rows.groupBy("fp").agg(F.min(place).alias("best"))
    # a class only meets in an aggregate, which is combined before the shuffle
    best = rooted(distinct).groupBy("root").agg(F.min("best").alias("best"))
    return common.unpacked(rows.join(best.select(F.col("best.row").alias("row")), "row", "left_semi"), docs)
