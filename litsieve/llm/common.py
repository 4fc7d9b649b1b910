"""What the operators share: word splitting, row packing, labelled samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space; ``bytes.split()`` cuts the same way.
BLANKS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def field(name: str) -> Column:
    """A column by its literal name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, name: str = "doc") -> DataFrame:
    """Every row as one struct, so that working columns cannot clash with its own."""
    return df.select(F.struct(*[field(c) for c in df.columns]).alias(name))


def unpacked(df: DataFrame, like: DataFrame, name: str = "doc") -> DataFrame:
    return df.select(*[F.col(name).getField(c).alias(c) for c in like.columns])


def text_of(name: str = "text") -> Column:
    """The text, an empty one in place of NULL."""
    return F.coalesce(field(name), F.lit(""))


def sampled_labels(labels: DataFrame, target: str, bound: int) -> DataFrame:
    """At most ``bound`` labelled rows (doc_id, label), the first in hash order.

    Rows without an ID or with a label other than 0 and 1 do not count. The
    order depends on the IDs alone, so every run picks the same rows.
    """
    rows = labels.select(field("doc_id").alias("doc_id"), field(target).cast("int").alias("label"))
    rows = rows.filter("doc_id is not null and label in (0, 1)")
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(bound)


def labelled_texts(docs: DataFrame, labels: DataFrame, target: str, bound: int) -> DataFrame:
    """(doc_id, label, text) of at most ``bound`` labelled documents.

    The sampled IDs are at most ``bound`` rows of two numbers, so they are broadcast
    and the documents are read once, where they lie.
    """
    picked = sampled_labels(labels, target, bound)
    texts = docs.select(field("doc_id").alias("doc_id"), text_of().alias("text"))
    return texts.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")
