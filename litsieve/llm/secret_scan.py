"""Secret scans with character Markov models, in column expressions only.

Base secrets are assignments, access keys and runs of hex digits. Beyond them, every run
of key characters long enough is scored by two character Markov models, one of random
strings and one of ordinary identifiers: the log-likelihood ratio of its characters, each
given the one before. The models are pair counts added up by Spark over labelled samples:
random are values of base secrets and digests in the usual alphabets made from row
numbers; ordinary are words that hold no base secret, of all documents. Only the two count
tables, at most ``_SIZE`` squared cells each whatever the input, reach the driver; the
ratios go back as one array literal.

Null texts count as empty; repeated rows are each returned; an empty table gives no rows, and
other columns, whatever their names, are ignored. Offsets are code points, ends exclusive; the
span of an assignment is all that its pattern matched. Texts of any length are scanned whole:
offsets of the matches take time in proportion to their number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litsieve.llm import common

# The base patterns.
ASSIGN = (
    "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 12

#: Runs of key characters shorter than this are no candidates, nor are plain numbers
#: shorter than ``LEAST_NUMBER``.
LEAST, LEAST_NUMBER = 12, 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{LEAST},}}"
#: Digests made for the random sample.
DIGESTS = 4_000
#: Mean log-likelihood ratio a character from which a run counts as random.
CUT = 0.35

_SIZE = 128
#: Matches whose offsets are summed in one piece.
_PIECE = 128


def _followed(steps: Column, first: Column) -> Column:
    """(start, end, hit) of the steps (gap, len, hit) of one piece, counted from ``first``.

    The array grows by copying, so a piece must be short.
    """
    empty = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")

    def follow(done: Column, step: Column) -> Column:
        start = F.coalesce(F.get(done, F.size(done) - 1)["end"], first) + step["gap"]
        one = F.struct(start.alias("start"), (start + step["len"]).alias("end"), step["hit"].alias("hit"))
        return F.concat(done, F.array(one))

    return F.aggregate(steps, empty, follow)


def _runs(df: DataFrame, name: str, pattern: str, hint: Column) -> DataFrame:
    """Add ``name``: (start, end, text) of the matches of a pattern, a group 1 kept as value.

    Pieces between matches and matches alternate, so starts are running sums of lengths.
    They are summed in two levels, by pieces of ``_PIECE`` matches and within each, so that
    a text with a million matches is no more than a long one. Texts without a match, by far
    the most, are not cut.
    """
    df = df.withColumn("hits", F.when(hint, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    some = F.size("hits") > 0
    df = df.withColumn("gaps", F.when(some, F.split("text", pattern, -1)))
    steps = F.zip_with(
        "hits", F.slice("gaps", F.lit(1), F.size("hits")),
        lambda h, g: F.struct(F.char_length(g).alias("gap"), F.char_length(h).alias("len"), h.alias("hit")),
    )
    df = df.withColumn("steps", steps)
    numbers = F.sequence(F.lit(0), F.floor((F.size("steps") - 1) / _PIECE).cast("int"))
    df = df.withColumn(
        "pieces", F.when(some, F.transform(numbers, lambda i: F.slice("steps", i * _PIECE + 1, F.lit(_PIECE))))
    )
    zero = F.lit(0).cast("bigint")
    width = lambda piece: F.aggregate(piece, zero, lambda n, step: n + step["gap"] + step["len"])
    last = lambda done: F.get(done, F.size(done) - 1)
    df = df.withColumn("widths", F.transform("pieces", width))
    df = df.withColumn(
        "firsts", F.aggregate("widths", F.array(zero), lambda done, w: F.concat(done, F.array(last(done) + w)))
    )
    runs = F.flatten(F.transform("pieces", lambda piece, i: _followed(piece, F.get("firsts", i))))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")
    df = df.withColumn(name, F.when(some, runs).otherwise(empty))
    return df.drop("hits", "gaps", "steps", "pieces", "widths", "firsts")


def base_spans(df: DataFrame) -> DataFrame:
    """Add ``assign``, ``access``, ``hex``: arrays of (start, end, hit) for ``text``."""
    df = _runs(df, "assign", ASSIGN, F.col("text").rlike("[:=]"))
    value = lambda s: F.regexp_extract(s["hit"], ASSIGN, 1)
    df = df.withColumn("assign", F.filter("assign", lambda s: F.length(value(s)) >= LEAST_VALUE))
    df = _runs(df, "access", ACCESS, F.col("text").contains("AKIA"))
    return _runs(df, "hex", HEX, F.lit(True))


# --- models


def samples(docs: DataFrame, digests: int = DIGESTS) -> DataFrame:
    """(value, random): labelled strings, those of the corpus from all documents."""
    spark = docs.sparkSession
    picked = base_spans(docs.select(common.text_of().alias("text")))
    found = F.concat(
        F.transform("assign", lambda s: F.regexp_extract(s["hit"], ASSIGN, 1)),
        F.transform("access", lambda s: s["hit"]), F.transform("hex", lambda s: s["hit"]),
    )
    words = F.regexp_extract_all("text", F.lit("[A-Za-z0-9+/_=-]{6,}"), F.lit(0))
    plain = F.filter(words, lambda w: ~w.rlike("[0-9]{3,}|" + HEX))
    labelled = lambda values, random: F.transform(
        values, lambda v: F.struct(v.alias("value"), F.lit(random).alias("random"))
    )
    # both kinds in one read of the documents
    seen = picked.select(F.explode(F.concat(labelled(found, True), labelled(plain, False))).alias("v")).select("v.*")
    digest = F.sha2(F.col("id").cast("string"), 256)
    made = spark.range(digests).select(
        F.explode(
            F.array(
                digest, F.upper(digest), F.base64(F.unhex(digest)),
                F.translate(F.base64(F.unhex(digest)), "+/=", "xQ7"),
                F.translate(F.base64(F.unhex(digest)), "+/=", "-_"),
                F.substring(F.upper(F.regexp_replace(F.base64(F.unhex(digest)), "[^A-Za-z0-9]", "")), 1, 20),
            )
        ).alias("value"),
        F.lit(True).alias("random"),
    )
    return seen.union(made)


def ratios(labelled: DataFrame, weight: float = 8.0) -> list[float]:
    """Log-likelihood ratio of every character given the one before, row by row.

    Counts are combined before the shuffle, and at most ``_SIZE`` squared cells of either
    kind come back. A pair falls back on its second character with ``weight`` counts, so
    that characters ordinary names hardly use tell even after a rare one.
    """
    pairs = F.transform(
        F.sequence(F.lit(1), F.length("value") - 1),
        lambda i: F.ascii(F.col("value").substr(i, F.lit(1))) * _SIZE + F.ascii(F.col("value").substr(i + 1, F.lit(1))),
    )
    rows = labelled.filter(F.length("value") > 1).select("random", F.explode(pairs).alias("pair"))
    rows = rows.filter(F.col("pair").between(0, _SIZE**2 - 1))
    counts = {True: [0.0] * _SIZE**2, False: [0.0] * _SIZE**2}
    for r in rows.groupBy("random", "pair").count().collect():
        counts[r.random][r.pair] = float(r["count"])
    logs = []
    for seen in counts.values():
        alone = [sum(seen[b::_SIZE]) + 0.5 for b in range(_SIZE)]
        whole = sum(alone)
        logs.append(
            [
                math.log(
                    (seen[a * _SIZE + b] + weight * alone[b] / whole)
                    / (sum(seen[a * _SIZE : (a + 1) * _SIZE]) + weight)
                )
                for a in range(_SIZE)
                for b in range(_SIZE)
            ]
        )
    return [r - o for r, o in zip(*logs)]


def _score(run: Column, table: Column) -> Column:
    """Mean log-likelihood ratio a character of a run of ASCII characters."""

    def one(total: Column, i: Column) -> Column:
        pair = F.ascii(run.substr(i, F.lit(1))) * _SIZE + F.ascii(run.substr(i + 1, F.lit(1)))
        return total + F.element_at(table, pair + 1)

    steps = F.length(run) - 1
    return F.aggregate(F.sequence(F.lit(1), steps), F.lit(0.0), one) / steps


def scanned(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """Per document row: doc_id, counts per base kind, digest of base spans, all spans."""
    table = ratios(samples(docs))
    literal = F.from_json(F.lit(str(table)), "array<double>")
    df = docs.select(common.field("doc_id").alias("doc_id"), common.text_of().alias("text"))
    df = _runs(base_spans(df), "random", CANDIDATE, F.lit(True))
    df = df.withColumn("base", F.concat("assign", "access", "hex"))
    free = F.filter(
        "random",
        lambda r: (~F.exists("base", lambda b: (r["start"] < b["end"]) & (b["start"] < r["end"])))
        & ~((F.length(r["hit"]) < LEAST_NUMBER) & r["hit"].rlike("^[0-9]+$"))
        & (_score(r["hit"], literal) >= cut),
    )
    df = df.withColumn("random", F.when(F.size("random") > 0, free).otherwise(F.col("random")))

    def named(i: int, kind: str) -> Column:
        def one(s: Column) -> Column:
            span = F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
            return F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), span.alias("span"))

        return F.transform(kind, one)

    def spans(kinds: tuple[str, ...]) -> Column:
        every = F.concat(*[named(i, k) for i, k in enumerate(kinds)])
        return F.array_join(F.transform(F.array_sort(every), lambda s: s["span"]), ",")

    return df.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(spans(KINDS[:3]).cast("binary"), 256).alias("base_sha256"), spans(KINDS).alias("spans"),
    )
