"""The seven relational tables article selection reads."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Tables:
    """Column names every operator relies on.

    refs        refs_key, isdiscard, year, creation_date, isreview, ref_type_key,
                createdby_key, journal, title, abstract      (refs_key unique)
    parts       refs_key, part_no, text_type, text_part, haspdf[, has_text]
    wf_status   refs_key, group_key, status_key, createdby_key, iscurrent
    tags        refs_key, tag_key
    status      refs_key, ap_status, gxd_status, go_status, tumor_status,
                qtl_status                                   (refs_key unique)
    terms       term_key, term                               (term_key unique)
    acc         object_key, accid, logicaldb_key, object_type_key, preferred
    """

    refs: DataFrame
    parts: DataFrame
    wf_status: DataFrame
    tags: DataFrame
    status: DataFrame
    terms: DataFrame
    acc: DataFrame


TABLE_NAMES = tuple(f.name for f in fields(Tables))


def flag_text(parts: DataFrame) -> DataFrame:
    """Add ``has_text``; stored with the parts, it saves reading texts to see if there are any."""
    return parts.withColumn("has_text", F.col("text_part").isNotNull())


def from_parquet(spark: SparkSession, folder: str) -> Tables:
    return Tables(**{n: spark.read.parquet(f"{folder}/{n}.parquet") for n in TABLE_NAMES})


def from_catalog(spark: SparkSession, database: str | None = None) -> Tables:
    prefix = f"{database}." if database else ""
    return Tables(**{n: spark.table(prefix + n) for n in TABLE_NAMES})


# The column each table is joined to the articles by.
ARTICLE_KEYS = {
    "refs": "refs_key", "parts": "refs_key", "wf_status": "refs_key", "tags": "refs_key",
    "status": "refs_key", "acc": "object_key",
}


def store_bucketed(t: Tables, database: str, buckets: int, mode: str = "errorifexists") -> None:
    """Save the tables so that all joins on the article find their rows in place.

    Every table of the articles is cut into the same buckets by its article key and sorted
    by it; read them with :func:`from_catalog`. The terms are no table of the articles.
    """
    for name in TABLE_NAMES:
        df = getattr(t, name)
        key = ARTICLE_KEYS.get(name)
        if key is None:
            df.write.mode(mode).saveAsTable(f"{database}.{name}")
        else:
            # one task per bucket, so that a bucket is one sorted file
            df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode(mode).saveAsTable(
                f"{database}.{name}"
            )


def key_cuts(keys: DataFrame, key: str, partitions: int, accuracy: int = 10_000) -> list[int]:
    """Ascending keys that cut the rows into ranges of about the same size.

    They are quantiles of the keys as they are, from a sketch, so gaps and crowds of
    numbers make no range large. A key that holds several shares of the rows is one range.
    """
    shares = [i / partitions for i in range(1, partitions)]
    if not shares:
        return []
    got = keys.agg(F.percentile_approx(key, shares, accuracy)).first()[0]
    return sorted(set(got or []))


def range_predicates(key: str, cuts: list[int]) -> list[str]:
    """SQL conditions of the ranges between the cuts, which together hold every row once."""
    if not cuts:
        return ["1 = 1"]
    inner = [f"{key} > {a} AND {key} <= {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{key} <= {cuts[0]} OR {key} IS NULL", *inner, f"{key} > {cuts[-1]}"]


def from_jdbc(spark: SparkSession, url: str, key_range: tuple[int, int] | None = None, partitions: int = 200,
              properties: dict[str, str] | None = None,
              table_names: dict[str, str] | None = None) -> Tables:
    """Scan over JDBC in key ranges, so that no single connection reads a whole table.

    Ranges are cut at quantiles of each table's keys, which are read first, in ``partitions``
    classes of remainders. ``key_range`` places even cuts instead; rows outside it go to the end
    ranges. ``table_names`` maps a table to the relation or view with the columns above.
    """
    key = dict.fromkeys(TABLE_NAMES, "refs_key") | {"terms": "term_key", "acc": "object_key"}
    properties = properties or {}

    def by_quantiles(relation: str, column: str) -> DataFrame:
        only_key = f"(SELECT {column} FROM {relation}) k"
        classes = [f"MOD(ABS({column}), {partitions}) = {i}" for i in range(partitions)]
        keys = spark.read.jdbc(url, only_key, predicates=classes, properties=properties)
        cuts = key_cuts(keys, column, partitions)
        return spark.read.jdbc(url, relation, predicates=range_predicates(column, cuts), properties=properties)

    def scan(name: str) -> DataFrame:
        relation = (table_names or {}).get(name, name)
        if key_range is None:
            return by_quantiles(relation, key[name])
        reader = spark.read.format("jdbc").options(
            url=url,
            dbtable=relation,
            partitionColumn=key[name],
            lowerBound=str(key_range[0]),
            upperBound=str(key_range[1]),
            numPartitions=str(partitions),
        )
        return reader.options(**properties).load()

    return Tables(**{n: scan(n) for n in TABLE_NAMES})
