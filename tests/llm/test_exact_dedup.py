"""Counting quotient filters and exact classes against plain counting."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litsieve.llm import exact_dedup
from litsieve.llm.quotient_filter import QuotientFilter, counted, merged

BITS = st.sampled_from([2, 5, 9, 16, 40, 64])


def _build(values, bits):
    array = np.array(values, np.uint64) & np.uint64(2**bits - 1)
    return QuotientFilter.build(*counted(array, np.ones(len(array), np.int64)), bits)


def _counts(f):
    values, counts = f.items()
    assert (values[1:] > values[:-1]).all()
    return dict(zip(values.tolist(), counts.tolist()))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 12), st.integers(0, 2**64 - 1)), max_size=200), BITS)
def test_round_trip(values, bits):
    f = _build(values, bits)
    assert _counts(f) == Counter(v & (2**bits - 1) for v in values)
    assert _counts(QuotientFilter.from_bytes(f.to_bytes())) == _counts(f)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=60), max_size=5), BITS)
def test_merge_loses_nothing(lists, bits):
    whole = merged([_build(v, bits) for v in lists], bits)
    assert whole.to_bytes() == _build([x for v in lists for x in v], bits).to_bytes()


@pytest.mark.parametrize("bits", [1, 3, 8, 20, 64])
@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 130, 10**6, 2**40])
def test_counters(bits, count):
    values = np.arange(min(2**bits, 50), dtype=np.uint64)
    counts = np.full(len(values), count, np.int64)
    counts[::3] = 1
    got = QuotientFilter.from_bytes(QuotientFilter.build(values, counts, bits).to_bytes()).items()
    assert (got[0] == values).all() and (got[1] == counts).all()


def test_is_smaller_than_its_numbers():
    values = np.unique(np.random.default_rng(3).integers(0, 2**64, 1 << 16, dtype=np.uint64))
    size = len(QuotientFilter.build(values, np.ones(len(values), np.int64), 64).to_bytes())
    assert size < 7 * len(values)


def _plain(rows):
    """(doc_id, keep_id, group_size, kept, sha) of (doc_id, text) rows by a dictionary."""
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for i, t in enumerate(norm):
        groups[t].append(i)
    out = Counter()
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        keep = min(ids, default=None)
        stays = next(i for i in members if rows[i][0] == keep)
        for i in members:
            sha = hashlib.sha256(norm[i].encode()).hexdigest()
            out[rows[i][0], keep, len(members), i == stays, sha] += 1
    return out


ROWS = (
    [(i, f"text number {i % 40}" + " \n"[i % 2] + "end") for i in range(150)]
    + [(1000 + i, "the same text\tin a third of all rows") for i in range(90)]
    + [(2000, None), (2001, ""), (2002, " "), (2003, "\n\t "), (None, ""), (None, None), (7, "text number 7\nend")]
    + [(None, "no one has an id"), (None, "no one  has an id"), (3000, "a" * 200_000), (3001, "a" * 200_000)]
)


@pytest.mark.parametrize("bits,shard", [(64, 1 << 20), (64, 8), (10, 64)])
def test_classes(spark, bits, shard):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = Counter(map(tuple, exact_dedup.classes(df, bits, shard).collect()))
    want = _plain(rows)
    # which of two equal rows with one doc_id stays is the order of the file: compare without
    assert got == want


def test_keep_first(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("row", F.lit("own"))
    got = exact_dedup.keep_first(df)
    assert got.columns == df.columns
    kept = got.collect()
    assert len(kept) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in ROWS})
    assert {r.row for r in kept} == {"own"}


def test_shared_address_fails(spark, monkeypatch):
    """Two texts at one address: the bytes decide, and the job says so."""
    real = F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: real(F.lit("same"), n))
    df = spark.createDataFrame([(i, f"t{i}") for i in range(300)], "doc_id long, text string")
    with pytest.raises(Exception, match="share fingerprint and digest"):
        exact_dedup.classes(df, bits=9).collect()
