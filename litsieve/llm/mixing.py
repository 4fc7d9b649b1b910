"""Mixing sources to target weights by systematic sampling.

Sources get targets in words by weight, none above ``MOST`` times its size. A document of
a source expects target / source size copies. Documents of a source stand in an order by
size class and hash; the running sum of expected copies plus one random offset per source
crosses an integer boundary once for each copy taken. Since neighbours have like sizes,
the words taken come close to the target.

The running sum needs no task that sees a whole source: documents fall into buckets of
size class and hash prefix, at most 8 size classes per doubling x 256 a source whatever its size; bucket
counts are added up per source, and ranks are taken within buckets.

Null sources are a source of their own, last in order; null and empty texts have size 0
and are drawn like others; repeated rows are drawn one by one; with no words at all every
target is 0 and nothing is taken. The draw depends on texts and IDs alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litsieve import session
from litsieve.llm import common

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix"


def words(text: Column) -> Column:
    """Number of words: places where a word begins."""
    text = F.coalesce(text, F.lit(""))
    for blank in "\t\n\v\f\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.size(F.array_remove(F.split(text, "\\x20"), "")).cast("bigint")


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources that reach their limit first, by limit over weight, are filled up one after
    the other; the rest share what is left by weight. This is what resharing the excess
    until none is above its limit comes to. The windows see one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((rank - 1) % len(WEIGHTS) + 1).cast("int"))
    rows = sizes.select("source", "source_size", weight.cast("double").alias("weight"))
    rows = rows.withColumn("limit", most * F.col("source_size"))
    line = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    after = line.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    # the first source that stays below its limit sets the level for all after it
    below = F.when(F.col("level") * F.col("weight") < F.col("limit"), F.col("level"))
    rows = rows.withColumn("level", F.max(below).over(everything))
    target = F.least(F.col("limit"), F.coalesce("level", F.lit(0.0)) * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def _place(size: Column, name: Column) -> tuple[Column, Column]:
    """(bucket, place): size class with hash prefix, and the whole hash."""
    bits = F.bin(size)
    size_class = F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.rpad(F.substring(bits, 2, 3), 3, "0"))
    place = F.md5(F.concat(F.lit(SEED + ":"), name).cast("binary"))
    return F.concat(size_class, F.substring(place, 1, 2)), place


def _offset(source: Column) -> Column:
    """A number from 0 to 1 for each source."""
    name = F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))
    digest = F.substring(F.md5(F.concat(F.lit(SEED + "@"), name).cast("binary")), 1, 8)
    return F.conv(digest, 16, 10).cast("bigint") / F.lit(float(16**8))


def _rows(docs: DataFrame) -> DataFrame:
    """Every row as ``doc`` with its size, source and place in the order."""
    rows = common.packed(docs)
    text, ident = F.col("doc").getField("text"), F.col("doc").getField("doc_id")
    name = F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    rows = rows.withColumns({"size": words(text), "name": name, "source": F.col("doc").getField("source")})
    bucket, place = _place(F.col("size"), F.col("name"))
    return rows.select(
        "doc", ident.alias("doc_id"), "size", "source", bucket.alias("bucket"), place.alias("place")
    )


def drawn(rows: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Rows (doc_id, size, source, bucket, place and more) with source_size, target and copies."""
    more = [c for c in rows.columns if c not in ("size", "source", "bucket", "place")]
    # a source of NULL is told apart by its own column in every grouping and join
    rows = rows.withColumn("nameless", F.col("source").isNull())

    buckets = rows.groupBy("source", "nameless", "bucket").agg(
        F.count("*").alias("n"), F.sum("size").alias("bucket_size")
    )
    buckets = session.materialise(buckets, "buckets")  # read three times; bounded per source
    sizes = buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    goals = targets(sizes, share, most).withColumn("rate", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
    goals = goals.withColumn("offset", _offset(F.col("source")))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("start", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    same = F.col("s.source").eqNullSafe(F.col("g.source"))
    starts = starts.alias("s").join(goals.alias("g"), same).select(
        F.col("s.source").alias("source"), "bucket", "start", "source_size", "target", "rate", "offset"
    )
    within = Window.partitionBy("source", "bucket").orderBy("place", "doc_id")
    ranked = rows.drop("nameless").withColumn("rank", F.row_number().over(within)).alias("r")
    found = ranked.join(
        starts.alias("b"),
        F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.bucket") == F.col("b.bucket")),
    )
    upper = F.floor(F.col("rate") * (F.col("start") + F.col("rank")) + F.col("offset"))
    lower = F.floor(F.col("rate") * (F.col("start") + F.col("rank") - 1) + F.col("offset"))
    return found.select(*more, "size", F.col("r.source").alias("source"), "source_size", "target", (upper - lower).alias("copies"))


def taken(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, size, source_size, target and the words taken.

    Texts are read once: what is drawn from are stored rows of a few numbers.
    """
    rows = session.materialise(_rows(docs).drop("doc"), "sized")
    return drawn(rows).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, number: str = "copy") -> DataFrame:
    """The mix itself: each document as often as it is taken, numbered from 1 on.

    A document's own column named like ``number`` is kept, and the number is then named
    with underscores before it.
    """
    while number in docs.columns:
        number = "_" + number
    rows = drawn(_rows(docs)).filter("copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    rows = rows.select("doc", copies.alias("copy"))
    return rows.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns], F.col("copy").alias(number))
