"""Named preprocessing steps over samples, and chains of them.

Each step is a DataFrame -> DataFrame function without a shuffle (bar the one
that joins side files), so chains run on batches and on streams alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.functions import clean, figures, rewrite
from litsieve.sources.archive import replace_text

Step = Callable[[DataFrame], DataFrame]
TEXT_FIELDS = ("title", "abstract", "extractedText")


def on_fields(fn: Callable[[Column], Column], fields: Iterable[str] = TEXT_FIELDS) -> Step:
    return lambda df: df.withColumns({f: fn(F.col(f)) for f in fields})


def figure_step(kind: str, n: int = 50) -> Step:
    return on_fields(lambda c: figures.figure_text(c, kind, n), ["extractedText"])


def _truncate(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "title": clean.head(F.col("title"), 10),
            "abstract": clean.head(F.col("abstract"), 20),
            "extractedText": F.concat(clean.head(F.col("extractedText"), 20), F.lit("\n")),
        }
    )


def _remove_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "title": clean.head(F.col("title"), 10),
            "abstract": F.lit("abstract..."),
            "extractedText": F.lit("extracted text...\n"),
        }
    )


def _add_journal(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "extractedText", clean.journal_feature(F.col("extractedText"), F.col("journal"))
    )


# Step names are part of the interface. Fixed values.
STEPS: dict[str, Step] = {
    "figureTextLegends": figure_step("legends"),
    "figureTextLegParagraphs": figure_step("legParagraphs"),
    "figureTextLegCloseWords50": figure_step("legCloseWords", 50),
    "featureTransform": on_fields(lambda c: rewrite.rewrite(c)),
    "removeURLsCleanStem": on_fields(lambda c: rewrite.clean_and_stem(c)),
    "removeURLs": on_fields(clean.remove_urls),
    "tokenPerLine": on_fields(clean.token_per_line),
    "truncateText": _truncate,
    "removeText": _remove_text,
    "addJournalFeature": _add_journal,
}


def preprocess(df: DataFrame, names: Iterable[str], extra: dict[str, Step] | None = None,
               side_texts: DataFrame | None = None) -> DataFrame:
    """Apply the named steps in order; ``extra`` adds or overrides steps."""
    steps = STEPS | (extra or {})
    if side_texts is not None:
        steps.setdefault("replaceText", lambda d: replace_text(d, side_texts))
    for name in names:
        if name not in steps:
            raise ValueError(f"unknown preprocessor {name!r}")
        df = df.transform(steps[name])
    return df


def document(df: DataFrame) -> Column:
    """The text a classifier sees."""
    return clean.make_document(*(F.col(f) for f in TEXT_FIELDS))


def with_lengths(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"abstractLen": F.length("abstract"), "textLen": F.length("extractedText")}
    )


def blurb_rows(df: DataFrame, key: str, text: str, kind: str = "legCloseWords",
               n: int = 50) -> DataFrame:
    """(key, pos, blurb): one row per figure passage."""
    return df.select(key, F.posexplode(figures.converter(kind, n)(F.col(text))).alias("pos", "blurb"))


# Lines between and after the passages of a text. Fixed values.
_BLURB_LINE, _LAST_LINE = "-" * 15, "-" * 13


def blurb_blocks(text: Column, kind: str = "legCloseWords", n: int = 50) -> Column:
    """The figure passages of a text as blocks under dashed lines."""
    blocks = F.transform(
        figures.converter(kind, n)(text),
        lambda b: F.concat(F.lit(f"{_BLURB_LINE}\n"), b, F.lit("\n")),
    )
    return F.concat(F.array_join(blocks, ""), F.lit(f"{_LAST_LINE}\n"))


def blurb_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Passages of an article that one extraction has more often than the other.

    One grouping instead of a set difference each way.
    """
    both = old.select(key, "blurb", F.lit(1).alias("n_old"), F.lit(0).alias("n_new")).unionByName(
        new.select(key, "blurb", F.lit(0).alias("n_old"), F.lit(1).alias("n_new"))
    )
    return (
        both.groupBy(key, "blurb")
        .agg(F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new"))
        .filter(F.col("n_old") != F.col("n_new"))
    )
