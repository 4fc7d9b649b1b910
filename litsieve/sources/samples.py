"""Sample files: records end in ``;;``, fields are split by ``|``.

A folder of part files stands for one sample file. Records may hold newlines.
Inline ``#meta`` and header records are understood when reading; written meta
goes to a ``_meta`` side folder, since part files have no common first line.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litsieve.functions.clean import ANY_SPACE
from litsieve.schema import FIELD_SEP, RECORD_END, SampleType, sample_type

META_MARK = "#meta"
_META_DIR = "_meta"


def to_record(kind: SampleType) -> Column:
    """One sample as record text (without the record end)."""
    return F.concat_ws(
        FIELD_SEP, *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in kind.fields]
    )


def parse_records(records: DataFrame, kind: SampleType, value: str = "value") -> DataFrame:
    """Record text -> sample fields; drops blank, meta and header records."""
    # A line break between records belongs to neither; a semicolon in front is
    # the end of a text that ended in one, just before its record end.
    text = F.regexp_replace(F.col(value), f"^;?{ANY_SPACE}*", "")
    rows = records.select(text.alias("record")).filter(
        (F.col("record") != "")
        & ~F.col("record").startswith(META_MARK)
        & (F.regexp_replace("record", f"{ANY_SPACE}+$", "") != kind.header)
    )
    parts = F.split("record", r"\|", -1)
    width = len(kind.fields)
    checked = F.when(F.size(parts) == width, parts).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {width} fields: "), F.substring("record", 1, 200)))
    )
    return rows.select(checked.alias("p")).select(
        [F.col("p")[i].alias(name) for i, name in enumerate(kind.fields)]
    )


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", RECORD_END).text(path)


def read_samples(spark: SparkSession, path: str, kind: SampleType | None = None) -> DataFrame:
    """Read a sample file; its type is taken from the meta data unless given."""
    if kind is None:
        kind = sample_type(read_meta(spark, path)["sampleObjType"])
    return parse_records(read_records(spark, path), kind)


def write_samples(df: DataFrame, path: str, kind: SampleType,
                  meta: Mapping[str, str] | None = None, mode: str = "errorifexists") -> None:
    record = to_record(kind)
    # keep a final semicolon apart from the record end
    record = F.when(record.endswith(";"), F.concat(record, F.lit(" "))).otherwise(record)
    (
        df.select(record.alias("value"))
        .write.mode(mode).option("lineSep", RECORD_END).text(path)
    )
    stamp_meta(df.sparkSession, path, {"sampleObjType": kind.name, **(meta or {})})


def stamp_meta(spark: SparkSession, path: str, meta: Mapping[str, str]) -> None:
    """(Re)write the meta data of a sample file without touching its records."""
    line = json.dumps(dict(meta), sort_keys=True)
    spark.range(1).select(F.lit(line).alias("value")).write.mode("overwrite").text(
        f"{path}/{_META_DIR}"
    )


def read_meta(spark: SparkSession, path: str) -> dict[str, str]:
    """Meta data from the side folder, else from an inline ``#meta`` record."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.text(f"{path}/{_META_DIR}").first()
    except AnalysisException:
        row = None
    if row is not None:
        return json.loads(row.value)
    inline = (
        read_records(spark, path)
        .filter(F.ltrim("value").startswith(META_MARK))
        .first()
    )
    if inline is None:
        return {}
    return dict(item.split("=", 1) for item in inline.value.split() if "=" in item)


def union_samples(parts: list[tuple[DataFrame, SampleType]]) -> DataFrame:
    """Concatenate sample sets that must all be of one type."""
    names = {kind.name for _, kind in parts}
    if len(names) != 1:
        raise ValueError(f"inconsistent sample types: {sorted(names)}")
    kind = parts[0][1]
    out = parts[0][0].select(*kind.fields)
    for df, _ in parts[1:]:
        out = out.unionByName(df.select(*kind.fields))
    return out


def records_to_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Keep the lines holding a record end and start a new line before each one."""
    marked = F.replace(F.col(value), F.lit(RECORD_END), F.lit("\n" + RECORD_END))
    return lines.filter(F.col(value).contains(RECORD_END)).withColumn(
        value, F.explode(F.split(marked, "\n"))
    )
