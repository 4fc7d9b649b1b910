"""Archive inputs: article XML, tar listings, side text files; per-journal output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litsieve.functions.clean import ANY_SPACE, scrub_non_ascii, underscore_spaces

def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """(type, pmcid, pmid, has_body, text, malformed) of every ``<article>`` element.

    The files are cut at the element's end tag, so a large file is read by many
    tasks and the whole element is at hand.
    """
    start = F.regexp_instr("value", F.lit(r"<article[\s>]"))
    elements = (
        spark.read.option("lineSep", "</article>").text(path)
        .filter(start > 0)
        .select(F.concat(F.col("value").substr(start, F.length("value")), F.lit("</article>")).alias("value"))
    )
    return article_fields(elements, "value").drop("value")


def article_fields(df: DataFrame, markup: str) -> DataFrame:
    """Article fields of the elements in a column, by path.

    The text is all character data in document order. The IDs and the body are those of
    the article itself, not of a sub-article. Markup that is no well-formed element has no
    fields and is kept in ``malformed``.
    """
    options = {"rowTag": "article", "columnNameOfCorruptRecord": "bad"}
    bad = F.from_xml(F.col(markup), "bad string", options)["bad"].isNotNull()
    meta = "/article/front/article-meta/article-id[@pub-id-type='{}']"
    df = df.withColumn("malformed", F.when(bad, F.col(markup)))
    # the paths raise an error on what is malformed, so they never see it
    fine = F.when(F.col("malformed").isNull(), F.col(markup))

    def found(path: str) -> Column:
        return F.nullif(F.xpath_string(fine, F.lit(path)), F.lit(""))

    return df.withColumns(
        {
            "type": found("/article/@article-type"),
            "pmcid": found(meta.format("pmc")),
            "pmid": found(meta.format("pmid")),
            "has_body": F.xpath_boolean(fine, F.lit("/article/body")),
            "text": scrub_non_ascii(F.xpath_string(fine, F.lit("/article"))),
        }
    )


def parse_listing(lines: DataFrame, value: str = "value", size_field: int = 2) -> DataFrame:
    """(path, size) of the ``.pdf`` lines of a verbose tar listing.

    The size stands at field 2 of a Linux listing and at field 4 of a macOS one.
    Other columns of the input, such as archive and position, are kept.
    """
    line = F.trim(F.col(value))
    part = F.split(line, f"{ANY_SPACE}+")
    keep = [c for c in lines.columns if c != value]
    return lines.filter(line.endswith(".pdf")).select(
        *keep, part[F.size(part) - 1].alias("path"), part[size_field].cast("long").alias("size")
    )


def read_side_texts(spark: SparkSession, path: str, suffix: str = ".new.txt") -> DataFrame:
    """(ID, new_text) of whole files named ``<ID><suffix>``."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return (
        spark.read.option("pathGlobFilter", f"*{suffix}").text(path, wholetext=True)
        .select(name.alias("name"), "value")
        .select(
            F.col("name").substr(F.lit(1), F.length("name") - len(suffix)).alias("ID"),
            F.col("value").alias("new_text"),
        )
    )


def replace_text(samples: DataFrame, side_texts: DataFrame) -> DataFrame:
    """Text from the side file where there is one, else the sample's own."""
    return (
        samples.join(side_texts, "ID", "left")
        .withColumn("extractedText", F.coalesce("new_text", "extractedText"))
        .drop("new_text")
    )


def write_by_journal(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Article texts below one folder per journal.

    Rows are brought together by journal so that no task writes a file for each,
    and a journal too large for one task is split into several files.
    """
    (
        df.withColumn("journal", underscore_spaces(F.col("journal")))
        .hint("rebalance", F.col("journal"))
        .write.mode(mode).partitionBy("journal").parquet(path)
    )
