"""Run a catalog query and its SQL side by side."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _norm(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v) for v in value)
    try:
        number = float(value)
    except (TypeError, ValueError):
        return str(value)
    return None if math.isnan(number) else round(number, 9)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in data]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(df, con, sql):
    """None if equal, else a short account of the difference."""
    spark_cols, spark_rows = rows(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    duck_cols, duck_rows = rows(names, result.fetchall())
    if spark_cols != duck_cols:
        return f"columns {spark_cols} != {duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows != {len(duck_rows)}; e.g. {_sample(spark_rows, duck_rows)}"
    if spark_rows != duck_rows:
        return f"values differ ({len(spark_rows)} rows): {_sample(spark_rows, duck_rows)}"
    return None


def _sample(a, b):
    sa, sb = set(a), set(b)
    return f"spark only {list(sa - sb)[:2]!r}, sql only {list(sb - sa)[:2]!r}"[:1500]
