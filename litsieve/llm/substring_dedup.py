"""Repeated passages across documents by difference-cover anchors.

A window is ``WINDOW`` consecutive words. Positions whose number modulo ``PERIOD`` lies in
a difference cover are anchor positions: for any two positions there is a shift below the
period that takes both of them to anchor positions. With anchors of window - period + 1
words, two equal windows share an anchor at the same place within them, whatever their
offsets. Only anchors are hashed and compared across documents, a quarter of all positions.

An anchor extends as far as a window that holds it can reach: period - 1 words to either
side. An anchor met at least twice is either pure, all its occurrences having the same
surroundings, so that every window around it is repeated as well; or mixed, and then the
windows around it are compared themselves.

Documents are dealt into parts of bounded text. A part names each anchor (and window) it
holds once, whatever its number of copies, so a passage that a third of all documents
share is one row a part. What is found goes back to the parts that asked, and each part
decides on its own documents. Nothing is capped or sampled; texts are cut whole.

Null and empty texts have no words; repeated rows are copies of each other; texts shorter
than a window lose nothing.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litsieve.llm import common

WINDOW = 35
PERIOD = 21
#: A perfect difference set: every number but 0 modulo 21 is a difference of two members.
COVER = (0, 1, 4, 14, 16)
#: Bytes of text that a part holds, in expectation.
PART_BYTES = 4_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of a hash, so that sums of hashes do not cancel out."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some documents one after the other, and hashes of any run of them."""

    def __init__(self, texts: list[str | None]):
        self.words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        number: dict[bytes, int] = {}
        ids = np.fromiter(
            (number.setdefault(w, len(number)) for ws in self.words for w in ws), np.int64, self.starts[-1]
        )
        digest = xxhash.xxh3_64_intdigest
        hashes = np.fromiter(map(digest, number), np.uint64, len(number))[ids] if len(ids) else np.zeros(0, np.uint64)
        n = len(hashes)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE, np.uint64)]))
            self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * power[:n])])
            self.undo = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _UNBASE, np.uint64)]))
        self.document = np.repeat(np.arange(len(texts)), self.sizes)
        self.inside = np.arange(n) - self.starts[self.document] if n else np.zeros(0, np.int64)
        self.left = self.sizes[self.document] - self.inside if n else self.inside  # words to the end

    def hash(self, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self.sums[to] - self.sums[at]) * self.undo[at] + (to - at).astype(np.uint64))


class Cover:
    """Anchors of a window length under a period and its difference cover."""

    def __init__(self, window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER):
        self.window, self.period, self.cover = window, period, cover
        self.size = window - period + 1
        reached = {(a - b) % period for a in cover for b in cover}
        if self.size < 1 or len(reached) != period:
            raise ValueError("no difference cover, or a period longer than the window")

    def anchors(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, anchor hash, surroundings hash) of all anchors in reach of a window."""
        fits = w.sizes[w.document] >= self.window if len(w.document) else np.zeros(0, bool)
        at = np.flatnonzero(fits & np.isin(w.inside % self.period, self.cover) & (w.left >= self.size))
        reach = self.period - 1
        before = np.minimum(w.inside[at], reach)
        after = np.minimum(w.left[at] - self.size, reach)
        anchor = w.hash(at, at + self.size)
        around = w.hash(at - before, at + self.size + after)
        with np.errstate(over="ignore"):
            around = _mixed(around + (before * (reach + 1) + after).astype(np.uint64) * _BASE)
        return at, anchor, around

    def touched(self, w: Words, starts: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which windows hold one of the anchors."""
        mark = np.zeros(len(w.document) + 1, np.int64)
        mark[at] = 1
        mark = np.concatenate([[0], np.cumsum(mark)])
        return mark[starts + self.period] > mark[starts]


def _known(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are among others, which come sorted."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _unsigned(table: pa.Table, kind: int) -> np.ndarray:
    """The sorted numbers of one kind that came back to a part."""
    rows = table.filter(pc.equal(table["kind"], kind))["key"].to_numpy()
    return np.unique(rows.view(np.uint64))


def _name_anchors(cover: Cover):
    """Each anchor of a part once: its surroundings, if they differ, if it is there twice."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        w = Words(part["text"].to_pylist())
        _, anchor, around = cover.anchors(w)
        order = np.argsort(anchor, kind="stable")
        anchor, around = anchor[order], around[order]
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(anchor) else order
        count = np.diff(np.r_[first, len(anchor)])
        least, most = (f.reduceat(around, first) if len(first) else around for f in (np.minimum, np.maximum))
        return pa.table(
            {
                "key": _signed(anchor[first]), "around": _signed(least), "mixed": pa.array(least != most),
                "part": pa.array(np.full(len(first), key[0].as_py(), np.int32)),
                "n": pa.array(np.minimum(count, 2).astype(np.int8)),
            }
        )

    return run


def _state(cover: Cover, part: pa.Table, known: pa.Table):
    """What a part knows of its windows once it has been told which anchors are met twice."""
    w = Words(part["text"].to_pylist())
    at, anchor, _ = cover.anchors(w)
    pure, mixed = _known(anchor, _unsigned(known, 0)), _known(anchor, _unsigned(known, 1))
    starts = np.flatnonzero(w.left >= cover.window)
    starts = starts[cover.touched(w, starts, at[pure | mixed])]
    sure = cover.touched(w, starts, at[pure])
    asked = cover.touched(w, starts, at[mixed])
    return w, starts, sure, asked


def _name_windows(cover: Cover):
    """Each window around a mixed anchor once, with whether the part has it twice."""

    def run(key: tuple, part: pa.Table, known: pa.Table) -> pa.Table:
        w, starts, _, asked = _state(cover, part, known)
        starts = starts[asked]
        hashes, count = np.unique(w.hash(starts, starts + cover.window), return_counts=True)
        return pa.table({"key": _signed(hashes), "part": pa.array(np.full(len(hashes), key[0].as_py(), np.int32)),
                         "n": pa.array(np.minimum(count, 2).astype(np.int8))})

    return run


def _decide(cover: Cover):
    """Per document what is left, once it is known which windows stand alone."""

    def run(key: tuple, part: pa.Table, known: pa.Table) -> pa.Table:
        w, starts, sure, asked = _state(cover, part, known)
        alone = np.zeros(len(starts), bool)
        alone[asked] = _known(w.hash(starts[asked], starts[asked] + cover.window), _unsigned(known, 2))
        repeated = starts[sure | (asked & ~alone)]
        edge = np.zeros(len(w.document) + 1, np.int64)
        np.add.at(edge, repeated, 1)
        np.add.at(edge, repeated + cover.window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        removed, kept = [], []
        for words, start, size in zip(w.words, w.starts.tolist(), w.sizes.tolist()):
            out = gone[start : start + size]
            count = int(out.sum())
            removed.append(count)
            kept.append(b" ".join([x for x, o in zip(words, out.tolist()) if not o] if count else words))
        return pa.table({"doc_id": part["doc_id"], "n_words": pa.array(w.sizes), "n_removed": pa.array(removed, pa.int64()),
                         "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                         "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    return run


def _parts(docs: DataFrame, part_bytes: int) -> DataFrame:
    """(part, doc_id, text): documents dealt evenly, by place and not by content."""
    rows = docs.select(common.field("doc_id").alias("doc_id"), common.text_of().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / part_bytes))
    return rows.select(
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int").alias("part"), "doc_id", "text"
    )


def deduplicated(docs: DataFrame, cover: Cover | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, kept_sha256 and kept, the words left.

    Every word of a window whose sequence of words starts anywhere else too is removed.
    """
    cover = cover or Cover()
    dealt = _parts(docs, part_bytes)
    kind = "key bigint, part int, n tinyint"
    named = dealt.groupBy("part").applyInArrow(_name_anchors(cover), "around bigint, mixed boolean, " + kind)
    # an anchor has one row a part, so even the most common one is a small group
    same = Window.partitionBy("key")
    mixed = F.max("mixed").over(same) | (F.min("around").over(same) != F.max("around").over(same))
    told = named.select("part", "key", mixed.cast("int").alias("kind"), F.sum("n").over(same).alias("n"))
    told = told.filter("n > 1").select("part", "kind", "key")

    def asked(known: DataFrame, step, schema: str) -> DataFrame:
        return dealt.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(step, schema)

    # one plan: Spark deals the texts out once and reads what it has dealt three times
    windows = asked(told, _name_windows(cover), kind)
    alone = windows.groupBy("key").agg(F.sum("n").alias("n"), F.max("part").alias("part")).filter("n = 1")
    told = told.union(alone.select("part", F.lit(2).alias("kind"), "key"))
    ident = dict(dealt.dtypes)["doc_id"]
    return asked(
        told, _decide(cover),
        f"doc_id {ident}, n_words bigint, n_removed bigint, kept_sha256 string, kept string",
    )
