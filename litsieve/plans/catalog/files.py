"""Record formats and side files."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from litsieve.plans.catalog.registry import query
from litsieve.plans.catalog.views import RULES, Inputs
from litsieve.operators import blocks, selection
from litsieve.schema import CLASSIFIED_REF
from litsieve.session import scratch_path
from litsieve.sources import archive, article_files, lists, ordered_tsv, predictions, sample_files, samples

_LABEL = "CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END"


@query("sample_roundtrip", f"""
    SELECT {_LABEL} AS "knownClassName", "ID", journal, title, abstract, "extractedText" FROM samples""")
def _(x: Inputs):
    """Written as record files with meta data, and read back by the type named there."""
    path = scratch_path(x.spark, "samples")
    labelled = x.view("samples").withColumn("knownClassName", F.expr(_LABEL))
    samples.write_samples(labelled, path, CLASSIFIED_REF, {"host": "none"})
    return samples.read_samples(x.spark, path)


@query("sample_file_roundtrip", f"""
    SELECT {_LABEL} AS "knownClassName", "ID", journal, title, abstract,
      concat("extractedText", CASE WHEN CAST("ID" AS BIGINT) % 3 = 0 THEN ';' ELSE '' END) AS "extractedText"
    FROM samples""")
def _(x: Inputs):
    """Written as the parts of one sample file, some texts ending in a semicolon, and read in small ranges."""
    path = scratch_path(x.spark, "sample-file")
    labelled = x.view("samples").withColumn("knownClassName", F.expr(_LABEL)).withColumn(
        "extractedText", F.concat("extractedText", F.expr("CASE WHEN CAST(ID AS BIGINT) % 3 = 0 THEN ';' ELSE '' END"))
    )
    sample_files.write_sample_file(labelled, path, CLASSIFIED_REF, {"host": "none"})
    return sample_files.read_sample_file(x.spark, path, split_bytes=1 << 18)


_ENDS = "replace(text, ' wild type ', ';;')"


@query("records_to_lines", f"""
    SELECT doc_id, unnest(string_split(replace(value, ';;', chr(10) || ';;'), chr(10))) AS value FROM
      (SELECT doc_id, unnest(string_split({_ENDS}, chr(10))) AS value FROM corpus) x
    WHERE contains(value, ';;')""")
def _(x: Inputs):
    lines = x.view("corpus").select("doc_id", F.explode(F.split(F.expr(_ENDS), "\n")).alias("value"))
    return samples.records_to_lines(lines)


_PRED_FIELDS = {
    "pubmed": "CAST(id AS STRING)",
    "predClass": "pred_class",
    "confidence": "CAST(id % 7 - 3 AS STRING)",
    "absValue": "CAST(abs(id % 7 - 3) AS STRING)",
    "trueClass": "true_class",
    "fpFn": "CASE WHEN pred_class = true_class THEN '' WHEN pred_class = 'keep' THEN 'FP' ELSE 'FN' END",
    "creationDate": "'01/02/2018'",
    "year": "'2018'",
    "isReview": "'0'",
    "refType": "'Peer Reviewed Article'",
    "suppStatus": "'ignore supp term'",
    "ap": "ap_status", "gxd": "gxd_status", "go": "go_status", "tumor": "tumor_status",
    "qtl": "qtl_status",
    "journal": "replace(journal, ' ', '_')",
    "abstractLen": "CAST(id % 1000 AS STRING)",
    "textLen": "CAST(id % 50000 AS STRING)",
}


def _parsed(x: Inputs):
    line = F.concat_ws("|", *[F.expr(e) for e in _PRED_FIELDS.values()])
    return predictions.parse_predictions(x.view("pred").select(line.alias("value")))


@query("prediction_parse",
       "SELECT " + ", ".join(f'lower({e}) AS "{f}"' for f, e in _PRED_FIELDS.items()) + " FROM pred")
def _(x: Inputs):
    return _parsed(x)


@query("prediction_long",
       "SELECT " + ", ".join(f'lower({_PRED_FIELDS[f]}) AS "{t}"' for f, t in predictions.LONG_OUTPUT.items())
       + " FROM pred")
def _(x: Inputs):
    return predictions.long_output(_parsed(x))


@query("id_map", """
    SELECT o_orderkey AS article, CAST(o_custkey AS STRING) AS pmid,
      concat(CASE WHEN o_custkey % 2 = 0 THEN 'PMC10' ELSE 'PMC9' END, CAST(o_custkey AS STRING)) AS pmcid
    FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)""")
def _(x: Inputs):
    """Even IDs have a second, later line: PMC10 after PMC9."""
    custkey = F.col("c_custkey").cast("string")

    def line(number: str, at: int) -> Column:
        value = F.concat(
            F.lit(f"oa/f.tar.gz\tcitation\t{number}"), custkey, F.lit("\tPMID:"), custkey, F.lit("\tCC BY")
        )
        return F.struct((F.col("c_custkey") + at).alias("line"), value.alias("value"))

    first, last = line("PMC9", 0), line("PMC10", 1_000_000_000)
    both = F.when(F.col("c_custkey") % 2 == 0, F.array(last, first)).otherwise(F.array(first))
    index = x.table("customer").select(F.inline(both))
    dated = x.spark.createDataFrame([(0, "2017-04-01 21:19:07")], "line long, value string")
    articles = x.table("orders").select(
        F.col("o_orderkey").alias("article"), F.col("o_custkey").cast("string").alias("pmid")
    )
    return lists.map_ids(articles, lists.parse_archive_index(index.union(dated)))


# Pages as article elements: either kind of quote, comments, character references, CDATA
# and sub-articles around a page's markup as text. Every seventh element is not closed.
_MARKUP = """concat('<article', CASE page_id % 4 WHEN 0 THEN ' article-type="type0"'
      WHEN 1 THEN concat(' article-type=', chr(39), 'type1', chr(39))
      WHEN 2 THEN ' id="x" article-type = "type2"' ELSE '' END,
    '><!-- <body>no</body> --><front><article-meta><article-id pub-id-type="pmc">', CAST(page_id AS STRING), '</article-id>',
    CASE WHEN page_id % 3 = 0 THEN '' ELSE concat('<article-id pub-id-type="pmid">',
      CAST(page_id * 2 AS STRING), '</article-id>') END, '</article-meta></front>',
    CASE WHEN page_id % 5 = 0 THEN '' ELSE concat('<body><p>', replace(replace(html, '&', '&amp;'), '<', '&lt;'),
      '</p><![CDATA[ a < b & c ]]>&#65;&#x3C;&amp;#945;</body>') END,
    '<sub-article><front><article-meta><article-id pub-id-type="pmid">999</article-id></article-meta></front>',
    CASE WHEN page_id % 7 = 6 THEN '' ELSE '</sub-article>' END, '</article>')"""

# what these elements hold, from how they were put together
_FIELDS = r"""
    CASE WHEN fine AND page_id % 4 < 3 THEN concat('type', CAST(page_id % 4 AS STRING)) END AS type,
    CASE WHEN fine THEN CAST(page_id AS STRING) END AS pmcid,
    CASE WHEN fine AND page_id % 3 <> 0 THEN CAST(page_id * 2 AS STRING) END AS pmid,
    CASE WHEN fine THEN page_id % 5 <> 0 END AS has_body,
    CASE WHEN fine THEN regexp_replace(concat(CAST(page_id AS STRING),
      CASE WHEN page_id % 3 <> 0 THEN CAST(page_id * 2 AS STRING) ELSE '' END,
      CASE WHEN page_id % 5 <> 0 THEN concat(html, ' a < b & c A<&#945;') ELSE '' END, '999'),
      '[^\x00-\x7F]', ' ', 'g') END AS text"""
_ELEMENTS = f"(SELECT page_id, html, page_id % 7 <> 6 AS fine, {_MARKUP} AS markup FROM pages) x"


@query("pages_parse", f"""
    SELECT page_id, CASE WHEN NOT fine THEN markup END AS malformed, {_FIELDS} FROM {_ELEMENTS}""")
def _(x: Inputs):
    pages = x.table("pages").select("page_id", F.expr(_MARKUP).alias("markup"))
    return archive.article_fields(pages, "markup").drop("markup")


@query("article_files", f"""
    SELECT CASE WHEN NOT fine THEN markup END AS malformed, {_FIELDS} FROM {_ELEMENTS}""")
def _(x: Inputs):
    """The same elements written to files and read back element by element."""
    path = scratch_path(x.spark, "articles")
    x.table("pages").select(F.expr(_MARKUP).alias("value")).write.text(path)
    return archive.read_articles(x.spark, path)


_LISTING = """concat('-rw-rw-r-- a/b ', CAST(size AS STRING), ' 2017-04-01 21:19 ', path)"""


@query("tar_listing", "SELECT archive_id, pos, path, size FROM files")
def _(x: Inputs):
    lines = x.view("files").select("archive_id", "pos", F.expr(_LISTING).alias("value"))
    folders = lines.withColumn("value", F.regexp_replace("value", "/[^/]*$", "/"))
    return archive.parse_listing(lines.unionByName(folders))


@query("replace_text", """
    SELECT s."ID", coalesce(n.html, s."extractedText") AS "extractedText"
    FROM samples s LEFT JOIN pages n ON s."ID" = CAST(n.page_id AS STRING)""")
def _(x: Inputs):
    side = x.table("pages").select(
        F.col("page_id").cast("string").alias("ID"), F.col("html").alias("new_text")
    )
    return archive.replace_text(x.view("samples"), side).select("ID", "extractedText")


@query("text_by_journal", "SELECT doc_id, replace(concat('J ', journal), ' ', '_') AS journal, text FROM clean")
def _(x: Inputs):
    path = scratch_path(x.spark, "by-journal")
    texts = x.view("clean").select("doc_id", F.concat(F.lit("J "), "journal").alias("journal"), "text")
    archive.write_by_journal(texts, path)
    return x.spark.read.parquet(path)


@query("article_texts", "SELECT replace(concat('J ', journal), ' ', '_') AS journal, CAST(doc_id AS STRING) AS article, text FROM clean")
def _(x: Inputs):
    """One file per article, below one folder per journal, read back by their names."""
    path = scratch_path(x.spark, "article-texts")
    texts = x.view("clean").select("doc_id", F.concat(F.lit("J "), "journal").alias("journal"), "text")
    article_files.write_article_files(texts, path, "doc_id", "text")
    return article_files.read_article_files(x.spark, path)


@query("export_tsv", """
    SELECT row_number() OVER (ORDER BY journal, pubmed, haspdf, year) AS line, pubmed, CAST(haspdf AS STRING) AS haspdf,
      CAST(year AS STRING) AS year, journal
    FROM (SELECT a.accid AS pubmed, p.haspdf, r.year, r.journal
      FROM refs r JOIN parts p ON r.refs_key = p.refs_key
        JOIN acc a ON a.object_key = r.refs_key AND a.logicaldb_key = 29 AND a.object_type_key = 1
      WHERE r.year >= 1999) e""")
def _(x: Inputs):
    """The ID export as one ordered table in parts, its lines numbered as they lie in the files."""
    path = scratch_path(x.spark, "ids")
    ordered_tsv.write_ordered_tsv(
        selection.known_ids(x.tables(), RULES, 1999), path, ["journal", "pubmed", "haspdf", "year"]
    )
    return blocks.numbered(ordered_tsv.read_ordered_tsv(x.spark, path), "line").select(
        (F.col("position") + 1).alias("line"), "pubmed", "haspdf", "year", "journal"
    )
