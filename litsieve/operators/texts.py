"""Article text: assembling its parts, joining it, and turning records into samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.functions.clean import as_text, clean_text, ingest_text, underscore_spaces
from litsieve.operators.bloom import Bloom
from litsieve.rules import GROUP_COLUMNS
from litsieve.schema import CUR_GROUP, PRIM_TRIAGE

# Order of the parts in an article. Fixed values.
PART_ORDER = (
    "body", "reference", "author manuscript fig legends", "star methods", "supplemental",
)


def part_rank(text_type: Column, order: tuple[str, ...] = PART_ORDER) -> Column:
    """Position of a part type; unknown types come last."""
    found = F.array_position(F.array(*map(F.lit, order)), text_type)
    return F.when(found > 0, found).otherwise(F.lit(len(order) + 1))


def ordered_text(order: tuple[str, ...] = PART_ORDER) -> Column:
    """Aggregate of the rows of an article that have a text part: its text."""
    ordered = F.array_sort(
        F.collect_list(
            F.struct(part_rank(F.col("text_type"), order).alias("rank"), "part_no", "text_part")
        )
    )
    return F.array_join(F.transform(ordered, lambda p: p["text_part"]), "")


def assemble_text(parts: DataFrame, order: tuple[str, ...] = PART_ORDER,
                  keys: DataFrame | None = None, likely: Bloom | None = None) -> DataFrame:
    """(refs_key, ext_text): the text parts of each article in type order.

    Pass ``keys`` to drop the parts of other articles first; stored keys of known
    size let Spark do that before text is shuffled. If there are too many of them to
    broadcast, ``likely``, a filter of the keys, drops almost all other parts in the scan.
    The result is one string per article, so an article's parts meet in one row
    by definition; nothing else is collected there.
    """
    rows = parts.filter(F.col("text_part").isNotNull())
    if likely is not None:
        rows = likely.keep(rows, "refs_key")
    if keys is not None:
        rows = rows.join(keys.select("refs_key"), "refs_key", "left_semi")
    return rows.groupBy("refs_key").agg(ordered_text(order).alias("ext_text"))


def join_text(records: DataFrame, texts: DataFrame, allow_no_text: bool = True) -> DataFrame:
    """Add ``ext_text``; an article without text gets '' or, if strict, fails the job."""
    text = F.col("ext_text")
    missing = F.lit("") if allow_no_text else F.raise_error(
        F.concat(F.lit("no text for article "), F.col("refs_key").cast("string"))
    )
    return records.join(texts, "refs_key", "left").withColumn(
        "ext_text", F.when(text.isNull(), missing).otherwise(text)
    )


def discard_label(isdiscard: Column, keep: str = "keep", discard: str = "discard") -> Column:
    return F.when(isdiscard == 1, F.lit(discard)).otherwise(F.lit(keep))


def keep_label(isdiscard: Column) -> Column:
    """The curation-group reading: anything but 0 is a discard."""
    return F.when(isdiscard.cast("string") == "0", F.lit("keep")).otherwise(F.lit("discard"))


def _common_fields(max_length: int, null_as: str) -> dict[str, Column]:
    def text(name: str) -> Column:
        return as_text(F.col(name), null_as)

    fields = {
        "ID": text("pubmed"),
        "creationDate": text("creation_date"),
        "year": text("year"),
        "isReview": text("isreview"),
        "refType": text("ref_type"),
        "suppStatus": text("supp_status"),
        "journal": underscore_spaces(text("journal")),
        "title": clean_text(F.col("title"), max_length, null_as),
        "abstract": clean_text(F.col("abstract"), max_length, null_as),
        "extractedText": ingest_text(F.col("ext_text"), max_length, null_as),
    }
    return fields | {f"{g}Status": text(c) for g, c in GROUP_COLUMNS.items()}


def triage_samples(records: DataFrame, max_length: int = 0, null_as: str = "") -> DataFrame:
    """Article records with text -> primary-triage samples (all strings)."""
    fields = _common_fields(max_length, null_as)
    fields["knownClassName"] = discard_label(
        F.col("isdiscard"), PRIM_TRIAGE.positive_class, PRIM_TRIAGE.negative_class
    )
    return records.select([fields[f].alias(f) for f in PRIM_TRIAGE.fields])


def group_samples(records: DataFrame, max_length: int = 0, null_as: str = "") -> DataFrame:
    """Article records with text -> curation-group samples."""
    fields = _common_fields(max_length, null_as)
    fields["knownClassName"] = F.col("known_class_name")
    fields["discardKeep"] = keep_label(F.col("isdiscard"))
    return records.select([fields[f].alias(f) for f in CUR_GROUP.fields])
