"""The inputs of the catalog: article tables derived from the given ones.

A view is SQL that Spark and the checking engine both understand, so queries
and their checks start from the same rows. Two views depend on regex functions
that the engines spell differently; Spark builds those with our own operators.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from litsieve.functions.clean import clean_text
from litsieve.rules import Rules
from litsieve.session import deal, spread, tune
from litsieve.sources.tables import TABLE_NAMES, Tables

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

RULES = Rules(
    start_date="1998-01-01",
    triage_date="1998-10-31",
    end_date="2000-12-31",
    tumor_start_date="1996-07-01",
    group_start={"ap": "1997-06-01", "go": "1996-01-01"},
    go_group="GO",
    go_indexed="Indexed",
    go_selected=("Chosen", "Indexed", "Full-coded"),
    go_loader=3,
    goa_creator=5,
    discard_creator=7,
    refs_only_tag="mice_in_references_only",
    peer_reviewed=1,
)

_GROUPS = {"ap": (1, 0), "gxd": (2, 3), "go": (3, 5), "tumor": (5, 7), "qtl": (7, 11)}

_STATUS = ", ".join(
    f"CASE (refs_key*{m}+{a}) % 13 WHEN 0 THEN 'Chosen' WHEN 1 THEN 'Indexed' "
    "WHEN 2 THEN 'Full-coded' WHEN 3 THEN 'Rejected' WHEN 4 THEN 'Rejected' "
    f"WHEN 5 THEN 'Routed' ELSE 'Not Routed' END AS {g}_status"
    for g, (m, a) in _GROUPS.items()
)

VIEWS: dict[str, str] = {
    "refs": """
        SELECT o.o_orderkey AS refs_key, CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS isdiscard,
          CAST(year(o.o_orderdate) AS INT) AS year, o.o_orderdate AS creation_date,
          CASE WHEN o.o_orderkey % 10 = 3 THEN 1 ELSE 0 END AS isreview,
          CAST(substr(o.o_orderpriority, 1, 1) AS INT) AS ref_type_key,
          CAST(o.o_custkey % 20 AS INT) AS createdby_key, concat('J ', c.c_mktsegment) AS journal,
          concat('Study ', CAST(o.o_orderkey AS STRING), ' | ', c.c_name) AS title,
          concat('Abstract;; of ', o.o_orderpriority, ' articles') AS abstract
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "status": f"SELECT refs_key, {_STATUS} FROM refs",
    "wf_status": """
        SELECT o_orderkey AS refs_key, CASE WHEN o_orderkey % 4 = 0 THEN 'GO' ELSE 'AP' END AS group_key,
          CASE o_orderkey % 3 WHEN 0 THEN 'Indexed' WHEN 1 THEN 'Chosen' ELSE 'Rejected' END AS status_key,
          CAST(o_custkey % 7 AS INT) AS createdby_key, 1 AS iscurrent FROM orders
        UNION ALL
        SELECT o_orderkey, 'GO', 'Indexed', CAST(o_custkey % 6 AS INT), 0 FROM orders WHERE o_orderkey % 5 = 0""",
    "tags": """
        SELECT o_orderkey AS refs_key, 'mice_in_references_only' AS tag_key FROM orders WHERE o_orderkey % 17 = 0
        UNION ALL
        SELECT o_orderkey, 'other tag' FROM orders WHERE o_orderkey % 3 = 0""",
    "terms": """
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS term_key, o_orderpriority AS term
        FROM orders""",
    "acc": """
        SELECT o_orderkey AS object_key, CAST(10000000 + o_orderkey AS STRING) AS accid, 29 AS logicaldb_key,
          1 AS object_type_key, 1 AS preferred FROM orders WHERE o_orderkey % 19 <> 0
        UNION ALL
        SELECT o_orderkey, CAST(90000000 + o_orderkey AS STRING), 29, 1, 0 FROM orders WHERE o_orderkey % 7 = 0
        UNION ALL
        SELECT o_orderkey, concat('J:', CAST(o_orderkey AS STRING)), 1, 1, 1 FROM orders""",
    "parts": """
        SELECT l_orderkey AS refs_key, l_linenumber AS part_no,
          CASE l_linenumber % 5 WHEN 0 THEN 'body' WHEN 1 THEN 'reference' WHEN 2 THEN 'supplemental'
            WHEN 3 THEN 'star methods' ELSE 'author manuscript fig legends' END AS text_type,
          CASE WHEN (l_orderkey + l_linenumber) % 50 = 0 THEN NULL
            ELSE MIN(concat(l_returnflag, l_linestatus, ' part ', CAST(l_partkey AS STRING))) END AS text_part,
          CAST(l_linenumber % 2 AS INT) AS haspdf
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "corpus": """
        SELECT d.doc_id, d.source AS journal, d.lang, l.quality,
          replace(replace(replace(replace(replace(replace(replace(replace(replace(
            d.text, chr(10), concat(chr(10), chr(10))),
            concat(chr(10), 'The '), concat(chr(10), 'Figure 1: ')),
            concat(chr(10), 'De '), concat(chr(10), 'Table 2 ')),
            ' that ', ' (Fig 3) '), ' was ', ' knock-out mouse '), ' with ', ' wild type '),
            ' for ', ' tumours at E12 in data '), ' is ', ' HeLa '), ' la ', ' tables ') AS text
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "clean": r"""
        SELECT doc_id, journal, lang, quality,
          regexp_replace(replace(replace(text, ';;', ' '), '|', ' '), '[^\x00-\x7F]', ' ', 'g') AS text
        FROM corpus""",
    "samples": """
        SELECT CAST(doc_id AS STRING) AS ID, journal, quality,
          concat('Figure text of mouse ', journal, ' HeLa') AS title,
          concat('Mouse study at https://example.org/', CAST(doc_id AS STRING), ' doi:10/', lang,
                 ' knock out') AS abstract,
          text AS extractedText
        FROM clean""",
    "pred": """
        SELECT r.refs_key AS id, CASE WHEN r.isdiscard = 1 THEN 'discard' ELSE 'keep' END AS true_class,
          CASE WHEN ((r.refs_key*7 + r.createdby_key) % 10 < 2) = (r.isdiscard = 1)
            THEN 'keep' ELSE 'discard' END AS pred_class,
          s.ap_status, s.gxd_status, s.go_status, s.tumor_status, s.qtl_status, r.journal, r.createdby_key
        FROM refs r JOIN status s ON r.refs_key = s.refs_key""",
    "files": """
        SELECT l_orderkey AS archive_id, l_linenumber AS pos,
          concat('A', CAST(l_orderkey AS STRING), '/', CASE l_partkey % 6 WHEN 0 THEN 'main' WHEN 1 THEN 'x-sup'
            WHEN 2 THEN 'y-s01' WHEN 3 THEN 'article-7' ELSE concat('p', CAST(l_partkey AS STRING), 'a') END,
            '.pdf') AS path,
          CAST(l_quantity * 1000 AS BIGINT) AS size
        FROM (SELECT l_orderkey, l_linenumber, MIN(l_partkey) AS l_partkey, MIN(l_quantity) AS l_quantity
              FROM lineitem GROUP BY l_orderkey, l_linenumber) x""",
    "candidates": """
        SELECT event_id AS pmcid, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id END AS pmid,
          concat('J ', CAST(user_id % 7 AS STRING)) AS journal, event_type AS type,
          event_id % 5 <> 0 AS has_pdf, event_id % 9 <> 0 AS has_body
        FROM events""",
    "monitored": """
        SELECT DISTINCT source AS journal FROM documents
        WHERE CAST(substr(source, 4, 10) AS INT) % 2 = 0""",
}


# Views with costly rows, and the key that deals out a small input file.
_SPREAD = {("corpus", "documents"): "doc_id"}
# Tables whose rows a view groups, and the key that deals them out in tasks of bounded size.
_DEALT = {"lineitem": "l_orderkey"}


def _needed(sql: str, known: dict[str, str]) -> list[str]:
    """Views the SQL mentions, each after the ones it builds on."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(known[name])
                order.append(name)

    visit(sql)
    return order


def with_views(sql: str, ctes: dict[str, str] | None = None) -> str:
    """The SQL with the views it needs as common table expressions."""
    known = VIEWS | (ctes or {})
    names = _needed(sql, known)
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in names) + "\n" + sql


class Inputs:
    """The tables and views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def _dealt(self, table: str) -> DataFrame:
        """The table dealt out by its key; its rows are counted once."""
        if f"{table} dealt" not in self._tables:
            self._tables[f"{table} dealt"] = deal(self.table(table), _DEALT[table])
        return self._tables[f"{table} dealt"]

    def view(self, name: str) -> DataFrame:
        if name == "clean":
            return self.view("corpus").withColumn("text", clean_text(F.col("text")))
        if name == "samples":
            return self._samples()
        sql = with_views(f"SELECT * FROM {name}")
        for table in BASE_TABLES:
            if re.search(rf"\b{table}\b", sql):
                df = self._dealt(table) if table in _DEALT else self.table(table)
                if (name, table) in _SPREAD:
                    df = spread(df, _SPREAD[name, table])
                df.createOrReplaceTempView(table)
        return self.spark.sql(sql)

    def _samples(self) -> DataFrame:
        doc_id = F.col("doc_id").cast("string")
        return self.view("clean").select(
            doc_id.alias("ID"), "journal", "quality",
            F.concat(F.lit("Figure text of mouse "), "journal", F.lit(" HeLa")).alias("title"),
            F.concat(F.lit("Mouse study at https://example.org/"), doc_id, F.lit(" doi:10/"),
                     "lang", F.lit(" knock out")).alias("abstract"),
            F.col("text").alias("extractedText"),
        )

    def tables(self) -> Tables:
        return Tables(**{n: self.view(n) for n in TABLE_NAMES})
