"""Spelling variants of the words of a corpus, by pivotal grams.

Words are near if one inserted, deleted or replaced code point tells them apart. The bigrams
of a word are put in one order for all words, rare ones first. The prefix of a word are its
bigrams up to the third in that order; its pivots are two bigrams of the prefix that share no
letter, chosen by dynamic programming to be rarest in sum. One edit destroys at most one
pivot. So of two near words the one whose prefix ends no later has a pivot that the other
holds, and holds within its own prefix.

An edit before the second pivot leaves that one and all after it as they are; any other edit
leaves the first pivot and all before it. So a word is asked for by the end that begins with
its second pivot and by the beginning that ends with its first one, and found by the ends and
beginnings at the bigrams of its prefix. Length and piece, which tell the place of the pivot,
are the key of an equality join. What it finds is verified by the edit distance within the join.

Bigrams are counted per occurrence in words; there are at most ``ALPHABET`` squared, whatever
the corpus, so their order is broadcast. A word's form is its most frequent near word, if
that is ``RATIO`` times as frequent; following forms, by doubling joins, leads to its root.
Counts grow fivefold along the way, so the rounds are few.

Null and empty texts have no words; of a row without a doc_id the ID is written as the empty
text; repeated rows count again; a run is read whole, however long; ties in frequency go to
the word first in code-point order; an empty table gives no rows; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litsieve import session
from litsieve.llm import common

RUN = "[A-Za-z\\u00C0-\\u00FF]"
#: Letters after lower-casing: a to z and U+00C0 to U+00FF.
ALPHABET = 26 + 64
EDITS = 1
GRAM = 2
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
SPOIL = 199

Gram = tuple[int, str, int]


# --- words


def spoiled(ident: Column, run: Column, every: int = SPOIL) -> Column:
    """The run without one code point if ``every`` divides the CRC-32 of ID and run."""
    name = F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(name.cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def counted_words(
    docs: DataFrame, every: int = SPOIL, length: int = LEAST_LENGTH, count: int = LEAST_COUNT
) -> DataFrame:
    """(word, n): words of ``length`` code points, met ``count`` times, and more.

    Counts are combined before the shuffle; a deletion only shortens, so shorter runs are
    never taken out of the text.
    """
    ident, text = common.field("doc_id"), common.text_of()
    runs = F.regexp_extract_all(text, F.lit(f"{RUN}{{{length},}}"), F.lit(0))
    rows = docs.select(ident.alias("doc_id"), F.explode(runs).alias("run"))
    low = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    rows = rows.select("doc_id", low.alias("run"))
    words = rows.select(spoiled(F.col("doc_id"), F.col("run"), every).alias("word"))
    words = words.filter(F.char_length("word") >= length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= count)


# --- grams


def bigram_counts(words: DataFrame) -> DataFrame:
    """(gram, n): how many places of words hold each bigram."""
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = F.transform(places, lambda i: F.substring(F.col("word"), i, F.lit(GRAM)))
    return words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


def prefix(word: str, counts: dict[str, int]) -> list[Gram]:
    """(count, gram, place) of the bigrams up to the third in the common order, by place.

    All places of the last gram belong to it, so that the prefix ends between two grams.
    """
    grams = [(counts[word[i : i + GRAM]], word[i : i + GRAM], i) for i in range(len(word) - GRAM + 1)]
    last = sorted(grams)[: GRAM * EDITS + 1][-1][:2]
    return [g for g in grams if g[:2] <= last]


def pivots(grams: Sequence[Gram], wanted: int = EDITS + 1) -> list[Gram]:
    """The ``wanted`` grams, by place, that share no letter and are rarest in sum."""
    # best[k]: cheapest choice of k grams so far; before[i] holds it up to gram i
    nothing: tuple[int, tuple[Gram, ...]] = (0, ())
    before: list[list[tuple[int, tuple[Gram, ...]] | None]] = [[nothing] + [None] * wanted]
    for i, gram in enumerate(grams):
        free = i
        while free and grams[free - 1][2] > gram[2] - GRAM:
            free -= 1
        best = list(before[i])
        for k in range(wanted):
            if (rest := before[free][k]) is not None:
                chosen = (rest[0] + gram[0], (*rest[1], gram))
                best[k + 1] = chosen if best[k + 1] is None else min(best[k + 1], chosen)
        before.append(best)
    assert before[-1][wanted] is not None, "three bigrams hold two that share no letter"
    return list(before[-1][wanted][1])


_PARTS = "struct<prefix:array<int>,pivots:array<int>,last:bigint>"
_PLACES = pa.list_(pa.int32())
_PARTS_TYPE = pa.struct([("prefix", _PLACES), ("pivots", _PLACES), ("last", pa.int64())])


def parts(word: Column, counts: dict[str, int]) -> Column:
    """Places of prefix and pivots of a word, and the number of its prefix's last bigram."""
    number = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}

    @F.arrow_udf(_PARTS)
    def cut(words: pa.Array) -> pa.Array:
        out = []
        for w in words.to_pylist():
            grams = prefix(w, counts)
            out.append({
                "prefix": [at for _, _, at in grams], "pivots": [at for _, _, at in pivots(grams)],
                "last": max(number[g] for _, g, _ in grams),
            })
        return pa.array(out, _PARTS_TYPE)

    return cut(word)


def _grams(words: DataFrame) -> DataFrame:
    """Words with prefix and pivots. The counts are at most ALPHABET ** 2 numbers."""
    counts = {r.gram: r.n for r in bigram_counts(words).toLocalIterator()}
    return words.withColumn("parts", parts(F.col("word"), counts)).select("word", "n", "parts.*")


def _pieces(word: Column, size: Column, last: Column, first: Column) -> Column:
    """The end from place ``last`` on, and the beginning through the bigram at ``first``."""
    ends = F.struct(F.lit(True).alias("end"), F.substring(word, last + 1, size).alias("piece"))
    begins = F.struct(F.lit(False).alias("end"), F.substring(word, F.lit(1), first + GRAM).alias("piece"))
    return F.array(ends, begins)


def near_words(words: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b): every pair of near words among (word, n), once, a before b. Stored."""
    rows = session.materialise(_grams(words), "grams")
    word, size = F.col("word"), F.char_length("word")
    held = rows.select("word", "n", "last", size.alias("size"), F.explode("prefix").alias("at"))
    held = held.select(
        F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("last").alias("last_b"), "size",
        F.inline(_pieces(word, F.col("size"), F.col("at"), F.col("at"))),
    )
    asked = rows.select(
        F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("last").alias("last_a"),
        F.explode(F.array(size - 1, size, size + 1)).alias("size"),
        _pieces(word, size, F.col("pivots")[1], F.col("pivots")[0]).alias("pieces"),
    )
    asked = asked.select("a", "n_a", "last_a", "size", F.inline("pieces"))
    same = [F.col(f"p.{c}") == F.col(f"h.{c}") for c in ("size", "end", "piece")]
    near = (F.col("last_a") <= F.col("last_b")) & (F.levenshtein("a", "b", EDITS) == 1)
    found = asked.alias("p").join(held.alias("h"), [*same, near])
    swap = F.col("a") > F.col("b")
    found = found.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        F.when(swap, F.col("n_b")).otherwise(F.col("n_a")).alias("n_a"),
        F.when(swap, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b"),
    )
    return session.materialise(found.distinct(), "pairs")


# --- forms


def _roots(links: DataFrame, most: int = 12) -> DataFrame:
    """(word, root) by doubling: everyone follows the link of whom the own link leads to."""
    now = session.materialise(links.toDF("word", "root"), "roots")
    for _ in range(most):
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(onward, "root", "left")
        after = session.materialise(step.select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        if after.filter("next is not null").isEmpty():
            return after.drop("next")
        now = after.drop("next")
    raise RuntimeError(f"forms did not end within 2 ** {most} steps")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Per row of (word, n): word, form, root, n, n_near, form_n."""
    words = session.materialise(words, "words")
    pairs = near_words(words)
    both = pairs.select("a", "b", "n_b").union(pairs.select("b", "a", "n_a")).toDF("word", "near", "near_n")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = words.join(near, "word", "left")
    takes = -F.col("best.less") >= ratio * F.col("n")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(takes, F.col("best.form")).alias("form"), F.when(takes, -F.col("best.less")).alias("form_n"),
    )
    rows = session.materialise(rows, "forms")
    roots = _roots(rows.filter("form is not null").select("word", "form"))
    rows = rows.join(roots, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def grouped(docs: DataFrame) -> DataFrame:
    """The spelling variants of all words of the documents."""
    return variants(counted_words(docs))
