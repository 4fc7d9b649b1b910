"""License scans by diagonal voting, in column expressions only.

Every rolling pair of words of a document, with the word after it, is hashed and joined
with the positions of all templates. A match votes for the diagonal document position less
template position; votes are added up per diagonal, neighbouring diagonals (words inserted
or left out) are merged, and a template counts where its votes cover enough of it and the
span they cover is not much longer than the template. Base phrases are templates of full
cover on a single diagonal: each is one window, so each vote is one place.

Documents are unrolled and probed inside one stage; only votes are shuffled, combined
before. Templates are a fixed list, so their few hundred windows are broadcast. One marker
per document, joined like a window, carries documents without a vote through the same
grouping, so the texts are read once.

Null texts count as empty; texts without words have no place and score 0; repeated rows
are each returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litsieve.llm import common

# Phrases and notices with their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
NOTICES = (
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    (
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at",
        "apache-2.0",
    ),
    ("Released under the MIT License", "mit"),
    (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
        "mit",
    ),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("GNU Lesser General Public License", "lgpl"),
    ("GNU Affero General Public License", "agpl"),
    ("Mozilla Public License, version 2.0", "mpl-2.0"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa-4.0"),
    ("Licensed under CC BY 4.0", "cc-by-4.0"),
    ("Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
)
#: Share of a notice's windows that must be found along a diagonal.
COVER = 0.75
#: Diagonals at most this far apart are one match.
NEIGHBOURS = 2

_GAPS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: The only other characters whose small form is an ASCII letter.
_CAPITALS = "[\\u0130\\u212A]"
_MARKER = -1


def words(text: Column) -> Column:
    """Words of ASCII letters, digits and anything beyond ASCII, A-Z lower-cased."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    small = F.when(text.rlike(_CAPITALS), F.translate(text, upper, lower)).otherwise(F.lower(text))
    return F.array_remove(F.split(F.regexp_replace(small, _GAPS, " "), "\\x20"), "")


def _with_keys(df: DataFrame) -> DataFrame:
    """Put ``hashes`` of the words and ``keys``, the hash of two words, for ``text``."""
    df = df.withColumn("words", words(F.col("text"))).drop("text")
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
    rest = F.greatest(F.size("hashes") - 1, F.lit(0))
    df = df.withColumn("next", F.slice("hashes", F.lit(2), rest))
    keys = F.zip_with(F.slice("hashes", F.lit(1), rest), "next", lambda a, b: F.xxhash64(a, b))
    return df.withColumn("keys", keys).drop("next")


def templates(spark: SparkSession) -> DataFrame:
    """(key, third, template, label, offset, total, size, base): windows of all templates."""
    rows = [(i, t, label, i < len(PHRASES)) for i, (t, label) in enumerate(PHRASES + NOTICES)]
    df = _with_keys(spark.createDataFrame(rows, "template int, text string, label string, base boolean"))
    df = df.select(
        "template", "label", "base", "hashes", F.size("hashes").alias("size"),
        F.posexplode("keys").alias("offset", "key"),
    )
    # a window has three words where the template has them; a phrase of two is a pair
    df = df.withColumn("third", F.get("hashes", F.col("offset") + 2)).filter("third is not null or size = 2")
    total = F.greatest(F.col("size") - 2, F.lit(1))
    out = df.select("key", "third", "template", "label", "offset", total.alias("total"), "size", "base")
    marker = spark.createDataFrame(
        [(_MARKER, None, _MARKER, None, 0, 1, 1, False)], out.schema.simpleString()[7:-1].replace(":", " ")
    )
    return out.union(marker)


def _votes(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Votes per (row, template, diagonal) with first and last position.

    The outer form of the generator keeps Spark from inferring a filter on the windows,
    which would compute them a second time; the join drops the empty rows.
    """
    df = _with_keys(docs)
    df = df.withColumn("keys", F.concat(F.array(F.lit(_MARKER).cast("bigint")), "keys"))
    df = df.select(
        "row", F.size("hashes").cast("bigint").alias("n_words"), "hashes",
        F.posexplode_outer("keys").alias("at", "key"),
    )
    df = df.join(F.broadcast(found), "key")
    df = df.filter(F.col("third").isNull() | (F.col("third") == F.get("hashes", F.col("at") + 1)))
    # the places of a phrase vote as one: which they are is all that matters
    line = F.when(~F.col("base"), F.col("at") - F.col("offset"))
    df = df.select(
        "row", "n_words", "template", "label", "base", "total", "size", line.alias("diagonal"),
        (F.col("at") - 1).cast("bigint").alias("pos"),
    )
    keys = [c for c in df.columns if c != "pos"]
    return df.groupBy(*keys).agg(
        F.count("*").alias("votes"), F.min("pos").alias("first"), F.max("pos").alias("last")
    )


def _verified(votes: DataFrame) -> DataFrame:
    """Add up neighbouring diagonals and mark the templates that are found: cover, base."""
    line = Window.partitionBy("row", "template").orderBy("diagonal")
    start = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > NEIGHBOURS, F.lit(True))
    votes = votes.withColumn("start", start.cast("int"))
    votes = votes.withColumn("band", F.sum("start").over(line))
    bands = votes.groupBy("row", "n_words", "template", "label", "base", "total", "size", "band").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    long = F.col("last") - F.col("first") + 3 > 1.5 * F.col("size") + NEIGHBOURS
    cover = F.least(F.col("votes") / F.col("total"), F.lit(1.0))
    fits = F.when(F.col("base"), F.lit(1.0)).when(long | (F.col("template") == _MARKER), F.lit(0.0)).otherwise(cover)
    return bands.withColumn("cover", fits)


def scanned(docs: DataFrame, cover: float = COVER) -> DataFrame:
    """Per document row: doc_id, n_words, places of base phrases, labels and score.

    The score is the best cover of any template, 1 for a base phrase.
    """
    ids = F.struct(F.monotonically_increasing_id().alias("n"), common.field("doc_id").alias("doc_id"))
    rows = docs.select(ids.alias("row"), common.text_of().alias("text"))
    found = _verified(_votes(rows, templates(docs.sparkSession)))

    def labels(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    out = found.groupBy("row").agg(
        F.first("n_words").alias("n_words"),
        F.coalesce(F.sum(F.when(F.col("base"), F.col("votes"))), F.lit(0)).cast("bigint").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("last"))).alias("last_word"),
        labels(F.col("base")).alias("base_labels"),
        labels(F.col("base") | (F.col("cover") >= cover)).alias("labels"),
        F.max("cover").alias("score"),
    )
    return out.select(F.col("row.doc_id").alias("doc_id"), *out.columns[1:])
