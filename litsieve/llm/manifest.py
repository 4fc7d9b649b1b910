"""Merkle manifest of a data set: one tree per language, their roots under one root.

Every row is a leaf. Leaves of a language are numbered in the order of doc_id by a range
partitioning, so no task sees a whole language; their numbers fall into aligned blocks of
2 ** ``LEVELS`` leaves. A task appends the leaves of a block one after the other and keeps their
partial witnesses (``witness``); the block's root is then appended, as one more leaf, to the
blocks of the next round, and so on until one root is left. What a block's root is given as
its witness extends those of all its leaves. The roots of the languages are appended alike.

A leaf is the digest of its fields with their lengths, so a NULL and an empty text differ.
Languages are ordered by their bytes, NULL first, rows without a doc_id come first within
theirs, and rows with the same doc_id stand in the order of their digests. Repeated rows are
leaves of their own. Texts of any length are hashed whole. An empty table has no rows and no
root. Other columns, whatever their names, are not part of a leaf.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litsieve import session
from litsieve.llm import common, witness

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of one block, which has two to that power leaves: a whole subtree.
LEVELS = 12

_Batches = Iterator[pa.RecordBatch]


def digest(values: Sequence[Column]) -> Column:
    """SHA-256 of fields, each with its length in bytes, '-' for NULL."""
    parts = []
    for value in values:
        text = value.cast("string")
        named = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(named, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _numbered(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with position and size within their ``tree``, (tree, size)).

    Positions come from running numbers within sorted range partitions: those of a
    partition are consecutive, so the counts per tree and partition are all that is left
    to add up.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    lined = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    lined = session.materialise(lined.withColumn("at", F.monotonically_increasing_id()), "lined")
    lined = lined.withColumn("part", F.shiftright("at", 33))
    parts = lined.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    line = Window.partitionBy("tree").orderBy("part")
    parts = parts.withColumns(
        {"start": F.sum("n").over(line) - F.col("n"), "size": F.sum("n").over(Window.partitionBy("tree"))}
    )
    parts = session.materialise(parts, "parts")
    found = lined.join(parts.select("tree", "part", "first", "start", "size"), ["tree", "part"])
    found = found.withColumn("position", F.col("at") - F.col("first") + F.col("start"))
    return found.drop("at", "part", "first", "start"), parts


def _appending(levels: int) -> Callable[[_Batches], _Batches]:
    """Adds witness and, on the first row of a block, root to rows sorted by block."""

    def block(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        tree = witness.Appender()
        for leaf in rows.column("digest").to_pylist():
            tree.append(leaf)
        root = tree.close(levels if rows.column("size")[0].as_py() > 1 << levels else 0)
        roots = [root] + [None] * (rows.num_rows - 1)
        out = rows.append_column("witness", pa.array(map(bytes, tree.witnesses), pa.binary()))
        yield from out.append_column("root", pa.array(roots, pa.binary())).combine_chunks().to_batches()

    def append(batches: _Batches) -> _Batches:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            keys = list(zip(batch.column("tree").to_pylist(), batch.column("block").to_pylist()))
            start = 0
            for i, key in enumerate(keys):
                if key != now:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if held:
                        yield from block(pa.Table.from_batches(held))
                    held, start, now = [], i, key
            if len(keys) > start:
                held.append(batch.slice(start))
        if held:
            yield from block(pa.Table.from_batches(held))

    return append


def _appended(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes (tree, position, size, digest and more) with block, witness and root of the block."""
    rows = nodes.withColumn("block", F.shiftright("position", levels))
    rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_appending(levels), schema + ", witness binary, root binary")


def _extended(rows: DataFrame, upper: DataFrame) -> DataFrame:
    """Witnesses extended by those that the roots of their blocks were given."""
    upper = upper.select("tree", F.col("position").alias("block"), F.col("witness").alias("more"))
    rows = rows.join(upper, ["tree", "block"])
    return rows.withColumn("witness", F.concat("witness", "more")).drop("more")


def witnessed(rows: DataFrame, order: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """Rows (tree, digest and more) with position, size, witness up to the tree's root, and root."""
    nodes, parts = _numbered(rows, order)
    rounds = [session.materialise(_appended(nodes, levels), "witnesses")]
    most = parts.agg(F.max("size")).first()[0] or 0
    while most > 1 << levels:
        most = -(-most >> levels)
        roots = rounds[-1].filter("root is not null").select(
            "tree", F.col("block").alias("position"), (-F.shiftright(-F.col("size"), levels)).alias("size"),
            F.col("root").alias("digest"),
        )
        rounds.append(session.materialise(_appended(roots, levels), "witnesses"))
    tops = rounds[-1].filter("root is not null").select("tree", "root")
    upper = None
    for level in reversed(rounds):
        upper = level if upper is None else _extended(level, upper)
    return upper.drop("root", "block").join(tops, "tree")


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Rows (doc_id, lang, digest and more) with all that proves them.

    Adds position, size (place in the language and its rows), lang_position, langs (the
    same for the language), witness (siblings from the leaf up to the root, 32 bytes each),
    subroot and root. ``leaves`` should be a stored table: it is read twice.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    # the number of a row lets a range end among repeated rows as well
    leaves = leaves.withColumns({"tree": tree, "row": F.monotonically_increasing_id()})
    below = witnessed(leaves, ["doc_id", "digest", "row"], levels).drop("row")
    below = session.materialise(below.withColumnRenamed("root", "subroot"), "manifest")
    tops = below.filter("position = 0").select(
        F.lit("").alias("tree"), F.col("tree").alias("branch"), F.col("subroot").alias("digest")
    )
    above = witnessed(tops, ["branch"], levels).select(
        F.col("branch").alias("tree"), F.col("position").alias("lang_position"), F.col("size").alias("langs"),
        F.col("witness").alias("more"), "root",
    )
    above = session.materialise(above, "roots")
    rows = below.join(above, "tree").withColumn("witness", F.concat("witness", "more"))
    return rows.drop("tree", "more")


_PROOF = "struct<proof_sha256:string,folded:binary>"
_PROOF_TYPE = pa.struct([("proof_sha256", pa.string()), ("folded", pa.binary())])


def folded(claim: Column) -> Column:
    """Digest of the witness, and the root that a claimed leaf leads to with it."""

    @F.arrow_udf(_PROOF)
    def fold(
        claims: pa.Array, witnesses: pa.Array, positions: pa.Array, sizes: pa.Array, places: pa.Array, langs: pa.Array
    ) -> pa.Array:
        out = []
        for leaf, path, position, size, place, n in zip(
            *(a.to_pylist() for a in (claims, witnesses, positions, sizes, places, langs))
        ):
            root, rest = witness.fold(leaf, path, position, size)
            out.append({"proof_sha256": sha256(path.hex().encode()).hexdigest(),
                        "folded": witness.fold(root, rest, place, n)[0]})
        return pa.array(out, _PROOF_TYPE)

    return fold(claim, F.col("witness"), F.col("position"), F.col("size"), F.col("lang_position"), F.col("langs"))


def leaves(docs: DataFrame, **more: Column) -> DataFrame:
    """(doc_id, lang, digest) of every row, and what else is asked for."""
    fields = [common.field(c) for c in FIELDS]
    return docs.select(
        common.field("doc_id").alias("doc_id"), common.field("lang").alias("lang"),
        digest(fields).alias("digest"), *[c.alias(name) for name, c in more.items()],
    )


def audited(docs: DataFrame, every: int = 7, levels: int = LEVELS) -> DataFrame:
    """The manifest's proofs, held against rows some of which were tampered with.

    A row is tampered with if ``every`` divides the CRC-32 of its doc_id: its n_chars is one
    too many. Rows without a doc_id or n_chars stay as they are.
    """
    ident, size = common.field("doc_id"), common.field("n_chars")
    hit = F.crc32(ident.cast("string").cast("binary")) % every == 0
    wrong = [common.field(c) for c in FIELDS]
    wrong[FIELDS.index("n_chars")] = size.cast("decimal(20,0)") + 1
    changed = F.when(hit & size.isNotNull(), digest(wrong))
    rows = manifest(session.materialise(leaves(docs, changed=changed), "leaves"), levels)
    rows = rows.withColumn("proof", folded(F.coalesce("changed", "digest")))
    names = {"leaf": "digest", "subroot": "subroot", "root": "root", "folded_root": "proof.folded"}
    shown = {name: F.lower(F.hex(c)).alias(name) for name, c in names.items()}
    return rows.select(
        "doc_id", shown["leaf"], shown["subroot"], shown["root"],
        F.col("proof.proof_sha256").alias("proof_sha256"), shown["folded_root"],
        (F.col("proof.folded") == F.col("root")).alias("verified"),
    )
