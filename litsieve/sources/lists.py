"""Small side inputs: journal lists, ID lists, the archive index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from litsieve.functions.clean import normalise_journal, strip


def journal_names(lines: DataFrame, value: str = "value") -> DataFrame:
    """Distinct normalised journal names, one input name per line."""
    name = normalise_journal(F.col(value))
    return lines.select(name.alias("journal")).filter(F.col("journal") != "").distinct()


def read_journals(spark: SparkSession, path: str) -> DataFrame:
    return journal_names(spark.read.text(path))


KNOWN_ID_SCHEMA = "pubmed string, haspdf string, year string, journal string"


def read_known_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=KNOWN_ID_SCHEMA)


def write_known_ids(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tab-separated export; range-sorted part files keep the order."""
    df.select("pubmed", "haspdf", "year", "journal").write.mode(mode).csv(
        path, sep="\t", header=True
    )


_DATE_LINE = r"^\s*\d{4}-\d{2}-\d{2}[\d\s:.]*$"


def parse_archive_index(lines: DataFrame, value: str = "value", line: str = "line",
                        quarantine: bool = False) -> DataFrame:
    """(line, pmid, pmcid) from index lines (file, citation, PMCID, ``PMID:n``, ...).

    ``line`` orders the lines. The date line at the top drops out; any other line with
    too few fields fails the job, or keeps its text in ``malformed``.
    """
    rows = lines.filter(~F.col(value).rlike(_DATE_LINE)).select(
        F.col(line).alias("line"), F.col(value).alias("value"),
        F.split(F.col(value), "\t", -1).alias("p"),
    )
    short = F.size("p") < 4
    if not quarantine:
        error = F.raise_error(F.concat(F.lit("short index line: "), "value"))
        rows = rows.withColumn("p", F.when(short, error.cast("array<string>")).otherwise(F.col("p")))
    pmid, pmcid = F.get("p", F.lit(3)), F.get("p", F.lit(2))
    rows = rows.select(
        "line", F.when(~short, F.substr(strip(pmid), F.lit(6))).alias("pmid"),
        F.when(~short, strip(pmcid)).alias("pmcid"), F.when(short, F.col("value")).alias("malformed"),
    )
    return rows if quarantine else rows.drop("malformed")


def read_archive_index(spark: SparkSession, path: str, quarantine: bool = False) -> DataFrame:
    """The index with its lines in file order."""
    place = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("n"),
    )
    lines = spark.read.text(path).select("value", place.alias("line"))
    return parse_archive_index(lines, quarantine=quarantine)


def map_ids(df: DataFrame, id_map: DataFrame, pmid: str = "pmid",
            quarantine: bool = False) -> DataFrame:
    """Add the PMCID of every row; an unmapped PMID fails the job or stays NULL."""
    # of several index lines for one PMID the last one counts
    known = id_map.filter(F.col("pmid").isNotNull())
    unique = known.groupBy(F.col("pmid").alias("_pmid")).agg(F.max_by("pmcid", "line").alias("pmcid"))
    joined = df.join(unique, F.col(pmid) == F.col("_pmid"), "left").drop("_pmid")
    if quarantine:
        return joined
    missing = F.raise_error(F.concat(F.lit("no PMCID for "), F.col(pmid).cast("string")))
    return joined.withColumn("pmcid", F.when(F.col("pmcid").isNull(), missing).otherwise(F.col("pmcid")))
