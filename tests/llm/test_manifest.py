"""Witnesses and manifests against trees built level by level."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litsieve.llm import manifest, witness


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(leaves):
    """(root, siblings of each leaf) of hex digests, all levels in full."""
    level, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for path, i in zip(paths, at):
            if i ^ 1 < len(level):
                path.append(level[i ^ 1])
        level = [H(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def _digests(n):
    return [hashlib.sha256(str(i).encode()).digest() for i in range(n)]


@pytest.mark.parametrize("n", [*range(1, 35), 63, 64, 65, 100])
def test_appender(n):
    leaves = _digests(n)
    tree = witness.Appender()
    for leaf in leaves:
        tree.append(leaf)
    root, paths = _tree([d.hex() for d in leaves])
    assert tree.close().hex() == root
    assert [w.hex() for w in tree.witnesses] == ["".join(p) for p in paths]
    for i, leaf in enumerate(leaves):
        assert witness.fold(leaf, bytes(tree.witnesses[i]), i, n) == (bytes.fromhex(root), b"")


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(0, 59), st.integers(0, 255))
def test_a_changed_leaf_changes_the_root(n, at, bit):
    leaves, at = _digests(n), at % n
    tree = witness.Appender()
    for leaf in leaves:
        tree.append(leaf)
    root = tree.close()
    wrong = bytearray(leaves[at])
    wrong[bit // 8] ^= 1 << bit % 8
    assert witness.fold(bytes(wrong), bytes(tree.witnesses[at]), at, n)[0] != root


def _leaf(row, n_chars):
    fields = (row.doc_id, row.source, row.lang, n_chars, row.text)
    texts = [None if f is None else str(f) for f in fields]
    return H(*("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def _plain(rows, every=7):
    langs = {}
    for r in rows:
        langs.setdefault(r.lang, []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for rs in langs.values():
        rs.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, _leaf(r, r.n_chars)))
    below = [_tree([_leaf(r, r.n_chars) for r in langs[x]]) for x in order]
    root, above = _tree([sub for sub, _ in below])
    out = Counter()
    for x, (sub, paths), up in zip(order, below, above):
        for r, path in zip(langs[x], paths):
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % every == 0
            fine = not hit or r.n_chars is None
            leaf = _leaf(r, r.n_chars)
            out[r.doc_id, leaf, sub, root, H(*path, *up), fine] += 1
    return out


def _rows(spark, n):
    langs = [None, "", "de", "en", "en", "en", "én"]
    rows = [
        (i - 5, None if i % 11 == 0 else f"s{i % 3}", langs[i % 7], None if i % 5 == 0 else i, None if i % 9 == 0 else f"täxt {i}")
        for i in range(n)
    ]
    rows += [(None, "a", "en", 1, "x"), (None, None, None, None, None), (3, "b", "en", 2, "x"), (3, "b", "en", 2, "x"),
             (2**63 - 1, "c", "zz", 2**63 - 1, "y" * 100_000), (10, "s", "lone", 1, "")]
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


@pytest.mark.parametrize("n,levels", [(0, 12), (90, 1), (90, 2), (90, 3), (300, 2), (300, 12)])
def test_manifest(spark, n, levels):
    docs = _rows(spark, n)
    got = manifest.audited(docs.repartition(6), levels=levels).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in got) == _plain(docs.collect())
    assert all((r.folded_root == r.root) == r.verified for r in got)
    assert any(not r.verified for r in got) or n == 0


def test_one_row(spark):
    docs = _rows(spark, 0).limit(1)
    (r,) = manifest.audited(docs).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == H()


def test_partitions_do_not_matter(spark):
    docs = _rows(spark, 120).withColumn("tree", F.lit("own")).withColumn("digest", F.lit("own"))
    got = [
        Counter(map(tuple, manifest.audited(docs.repartition(n, F.rand(n)), levels=3).collect())) for n in (1, 4, 13)
    ]
    assert got[0] == got[1] == got[2]
