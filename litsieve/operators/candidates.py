"""Finding extra negative articles: corpus filter, outcomes, the main archive file."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

# Article types seen before, and whether they are wanted. Fixed values.
ARTICLE_TYPES: Mapping[str, bool] = {
    "research-article": True,
    "review-article": False,
    "other": False,
    "correction": False,
    "editorial": False,
    "article-commentary": False,
    "brief-report": False,
    "case-report": False,
    "letter": False,
    "discussion": False,
    "retraction": False,
    "oration": False,
    "reply": False,
    "news": False,
}

MICE = r"(?i)\bmice\b"


def candidate_search(corpus: DataFrame, journals: DataFrame, date_from: str, date_to: str,
                     texts: Iterable[str] = ("title", "abstract", "text"),
                     mice_only: bool = True) -> DataFrame:
    """Open-access articles of the listed journals that mention mice, both days included."""
    found = corpus.filter(
        (F.col("creation_date") >= F.to_timestamp(F.lit(date_from)))
        & (F.col("creation_date") < F.date_add(F.to_date(F.lit(date_to)), 1).cast("timestamp"))
        & F.col("open_access")
    )
    if mice_only:
        condition = F.lit(False)
        for name in texts:
            condition |= F.coalesce(F.col(name).rlike(MICE), F.lit(False))
        found = found.filter(condition)
    return found.join(journals.select("journal").distinct(), "journal", "left_semi")


# Outcomes in the order they are decided.
NO_ID, IN_DB, SKIPPED_TYPE, NEW_TYPE, WANTED = (
    "no_pmid", "in_db", "skipped_type", "new_type", "wanted",
)


def key_of(pmid: str = "pmid", article_id: str = "pmcid") -> Column:
    """What articles are joined by. Those without a PMID match nothing; they are spread by
    their own ID instead of sending all the NULLs to one task."""
    return F.coalesce(
        F.col(pmid).cast("string"), F.concat(F.lit("no pmid "), F.col(article_id).cast("string"))
    )


def decide(known: Column, types: Mapping[str, bool] = ARTICLE_TYPES, pmid: str = "pmid",
           kind: str = "type") -> Column:
    """The outcome of an article: known ones are told before the type is looked at."""
    wanted = [t for t, want in types.items() if want]
    unwanted = [t for t, want in types.items() if not want]
    return (
        F.when(F.col(pmid).isNull(), NO_ID)
        .when(known, IN_DB)
        .when(F.col(kind).isin(*wanted), WANTED)
        .when(F.col(kind).isin(*unwanted), SKIPPED_TYPE)
        .otherwise(NEW_TYPE)
    )


def with_outcome(articles: DataFrame, known: DataFrame,
                 types: Mapping[str, bool] = ARTICLE_TYPES, pmid: str = "pmid",
                 kind: str = "type", article_id: str = "pmcid") -> DataFrame:
    """Add ``outcome``: an article is known before its type is looked at."""
    known_ids = known.select(F.col(pmid).alias("_known")).distinct()
    return (
        articles.withColumn("_key", key_of(pmid, article_id))
        .join(known_ids.withColumn("_key", F.col("_known").cast("string")), "_key", "left")
        .withColumn("outcome", decide(F.col("_known").isNotNull(), types, pmid, kind))
        .drop("_key", "_known")
    )


def outcome_report(outcomes: DataFrame) -> DataFrame:
    """One row per journal: articles found, lost for each reason, written.

    Expects ``outcome`` and, for wanted articles, ``has_body`` and ``has_pdf``.
    """
    is_wanted = F.col("outcome") == WANTED
    counts = outcomes.groupBy("journal").agg(
        F.count("*").alias("found"),
        *[F.count_if(F.col("outcome") == o).alias(o)
          for o in (NO_ID, IN_DB, SKIPPED_TYPE, NEW_TYPE)],
        F.count_if(is_wanted & ~F.col("has_pdf")).alias("no_pdf"),
        F.count_if(is_wanted & ~F.col("has_body")).alias("no_body"),
        F.count_if(is_wanted & F.col("has_pdf")).alias("pdf_written"),
        F.count_if(is_wanted).alias("text_written"),
    )
    lost = sum((F.col(c) for c in (SKIPPED_TYPE, NEW_TYPE, IN_DB, "no_pdf", NO_ID)), F.lit(0))
    return counts.withColumn("matching", F.col("found") - lost)


def outcome_examples(outcomes: DataFrame, article_id: str = "pmcid", n: int = 6,
                     pmid: str = "pmid") -> DataFrame:
    """(journal, outcome, type, num, examples): the first n IDs of every kind of loss.

    Known articles and those without a PDF or body are listed by PMID, others by archive ID.

    The rank bound is applied before the shuffle as well, so a journal that
    holds most articles still sends only n rows per task to be ranked.
    """
    kind = F.when(F.col("outcome").isin(SKIPPED_TYPE, NEW_TYPE), F.col("type"))
    is_wanted = F.col("outcome") == WANTED
    reasons = F.when(~is_wanted, F.array("outcome")).otherwise(
        F.array_compact(
            F.array(F.when(~F.col("has_pdf"), F.lit("no_pdf")),
                    F.when(~F.col("has_body"), F.lit("no_body")))
        )
    )
    lost = outcomes.select(
        "journal", F.explode(reasons).alias("outcome"), kind.alias("type"), article_id, pmid
    )
    by_pmid = F.col("outcome").isin(IN_DB, "no_pdf", "no_body")
    lost = lost.select(
        "journal", "outcome", "type",
        F.when(by_pmid, F.col(pmid)).otherwise(F.col(article_id)).alias("id"),
    )
    keys = ["journal", "outcome", "type"]
    counts = lost.groupBy(*keys).agg(F.count("*").alias("num"))
    first = (
        lost.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("id")))
        .filter(F.col("rank") <= n)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )
    same = [counts[k].eqNullSafe(first[k]) for k in keys]
    return counts.join(first, same, "left").select(
        *[counts[k] for k in keys], "num",
        F.array_join(F.transform("ids", lambda i: i.cast("string")), ", ").alias("examples"),
    )


# -- main file of an archive -------------------------------------------------

# File name patterns (without .pdf), matched from the start. Fixed values.
MAIN_NAMES = (
    r".*main$", r".*article[-_]*[0-9]*$", r"nihms[-_]*[0-9]+$", r"ncomms[0-9]+$", r"onc[0-9]+a$",
)
SUPPLEMENT_NAMES = (
    r".*sup.*", r".*sd.*", r".*s[0-9]+$", r".*data.*", r".*fig.*", r".*table.*", r".*video.*",
    r"bj.*add$",
)


def _matches(name: Column, patterns: Iterable[str]) -> Column:
    return name.rlike("(?i)^(?:" + "|".join(patterns) + ")")


def base_name(path: Column) -> Column:
    return F.regexp_replace(path, "^.*/", "")


def _picked(files: DataFrame, archive: str) -> DataFrame:
    name = F.replace(base_name(F.col("path")), F.lit(".pdf"), F.lit(""))
    is_main = _matches(name, MAIN_NAMES)
    sized = ~is_main & ~_matches(name, SUPPLEMENT_NAMES) & (F.col("size") > 0)
    here = F.struct("pos", "path")
    back = F.struct("size", (-F.col("pos")).alias("back"), "path")
    judged = files.select(archive, "pos", "path", "size", is_main.alias("m"), sized.alias("c"))
    grouped = judged.groupBy(archive).agg(
        F.min(F.when(F.col("m"), here)).alias("main"),
        F.max(F.when(F.col("c"), back)).alias("largest"),
        F.min(F.when(F.col("c"), F.struct("pos", "size"))).alias("first"),
        F.min("pos").alias("first_pos"),
        F.count("*").alias("n_files"),
    )
    main, largest = F.col("main"), F.col("largest")
    return grouped.select(
        archive,
        F.coalesce(main["path"], largest["path"]).alias("path"),
        F.coalesce(main["pos"], -largest["back"]).alias("pos"),
        F.when(main.isNotNull(), F.lit("m"))
        .when(largest["size"] == F.col("first")["size"], F.lit("o"))
        .when(largest.isNotNull(), F.lit("s"))
        .alias("reason"),
        "first_pos", "n_files",
    )


def main_file(files: DataFrame, archive: str = "archive_id") -> DataFrame:
    """(archive, path, pos, reason) of the article's own PDF in each archive.

    ``files`` lists the PDFs of an archive in order ``pos``. The first one named
    like a main file wins (reason ``m``). Otherwise it is the largest one that
    is not named like a supplement, the first of equals (``o`` if the first
    candidate was already the largest, ``s`` if a later one beat it). Without
    either, path and reason are NULL. Everything is a combinable aggregate, so
    even an archive with most of the files is reduced before the shuffle.
    """
    return _picked(files, archive).drop("first_pos", "n_files")


def main_file_log(files: DataFrame, archive: str = "archive_id") -> DataFrame:
    """(archive, reason, chosen, other_pos, other): the other files looked at.

    One row per other base name, so that no archive's names are collected; an
    archive without others has one row with NULLs. A main file ends the look, so
    then only the names before it appear.
    """
    picked = _picked(files, archive).select(
        archive, "reason", F.col("path").alias("chosen"), F.col("pos").alias("chosen_pos"),
        "first_pos", "n_files",
    )
    by_name = F.col("reason") == "m"
    seen = (F.col("pos") != F.col("chosen_pos")) & (
        ~by_name | (F.col("pos") < F.col("chosen_pos"))
    )
    # An archive with nothing to list shows its first file's row, without a name.
    alone = F.col("chosen").isNull() | F.when(
        by_name, F.col("first_pos") == F.col("chosen_pos")
    ).otherwise(F.col("n_files") == 1)
    first = alone & (F.col("pos") == F.col("first_pos"))
    # An inner join, so that a huge archive can be split.
    rows = files.select(archive, "pos", "path").join(picked, archive)
    listed = F.coalesce(seen & ~alone, F.lit(False))
    return rows.filter(listed | first).select(
        archive, "reason", "chosen", F.when(listed, F.col("pos")).alias("other_pos"),
        F.when(listed, base_name(F.col("path"))).alias("other"),
    )
