"""Article selection, joins and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from litsieve.operators import candidates, selection, texts
from litsieve.operators.reports import journal_windows
from litsieve.plans import build
from litsieve.plans.catalog.registry import query
from litsieve.plans.catalog.views import RULES, Inputs
from litsieve.rules import GROUP_COLUMNS
from litsieve.session import scratch_path
from litsieve.streaming import arrivals, assembly
from litsieve.streaming.state import append

_SELECTED = "('Chosen', 'Indexed', 'Full-coded')"
_ANY = "(" + " OR ".join(f"s.{c} IN {_SELECTED}" for c in GROUP_COLUMNS.values()) + ")"
_NONE = " AND ".join(f"s.{g}_status IN ('Not Routed', 'Rejected')" for g in ("ap", "gxd", "tumor", "qtl"))


def _ts(date: str) -> str:
    return f"TIMESTAMP '{date}'"


_OMIT = f"""
    SELECT DISTINCT r.refs_key, a.accid AS pubmed
    FROM refs r JOIN wf_status bs ON r.refs_key = bs.refs_key AND bs.iscurrent = 1
      JOIN status s ON r.refs_key = s.refs_key
      LEFT JOIN tags bt ON r.refs_key = bt.refs_key
      JOIN acc a ON a.object_key = r.refs_key AND a.logicaldb_key = 29 AND a.object_type_key = 1
    WHERE (((bs.status_key = 'Indexed' AND bs.group_key = 'GO' AND bs.createdby_key = 3) OR r.createdby_key = 5)
           AND {_NONE} AND r.creation_date >= {_ts(RULES.start_date)})
       OR (r.isdiscard = 1 AND bt.tag_key = 'mice_in_references_only')"""


def _base_sql(where: str) -> str:
    return f"""
    SELECT DISTINCT r.refs_key, r.creation_date FROM refs r JOIN parts p ON r.refs_key = p.refs_key
    WHERE p.text_part IS NOT NULL AND {where}"""


_NOT_OMITTED = "NOT EXISTS (SELECT 1 FROM omit o WHERE o.refs_key = r.refs_key)"
_CTES = {
    "omit": _OMIT,
    "base": _base_sql(f"r.createdby_key <> 7 AND {_NOT_OMITTED}"),
    "backpop": _base_sql(f"r.createdby_key = 7 AND {_NOT_OMITTED}"),
    "gbase": _base_sql("1 = 1"),
}

_WHERE = {
    "discard_after": f"r.isdiscard = 1 AND tr.creation_date > {_ts(RULES.triage_date)} "
                     f"AND tr.creation_date <= {_ts(RULES.end_date)}",
    "keep_after": f"{_ANY} AND tr.creation_date > {_ts(RULES.triage_date)} "
                  f"AND tr.creation_date <= {_ts(RULES.end_date)}",
    "keep_before": f"{_ANY} AND tr.creation_date >= {_ts(RULES.start_date)} "
                   f"AND tr.creation_date <= {_ts(RULES.triage_date)}",
    "keep_tumor": f"s.tumor_status IN {_SELECTED} AND tr.creation_date >= {_ts(RULES.tumor_start_date)} "
                  f"AND tr.creation_date <= {_ts(RULES.start_date)}",
    "future_test": f"tr.creation_date > {_ts(RULES.end_date)} AND (r.isdiscard = 1 OR {_ANY})",
}
_RESTRICT = " AND r.ref_type_key = 1 AND r.isreview <> 1"
_GO_EXISTS = f"""EXISTS (SELECT 1 FROM wf_status bs WHERE bs.refs_key = r.refs_key AND bs.group_key = 'GO'
    AND bs.status_key IN {_SELECTED} AND bs.createdby_key <> 3)"""


def _search_where(group: str, search: str) -> str:
    col = f"s.{group}_status"
    if search == "unselected_after":
        return (f"tr.creation_date > {_ts(RULES.triage_date)} AND "
                f"((r.isdiscard = 1 AND r.createdby_key <> 7) OR {col} = 'Rejected')")
    parts = [f"{col} IN {_SELECTED}"]
    if search == "selected_after":
        parts += [f"tr.creation_date > {_ts(RULES.triage_date)}", "r.isdiscard = 0"]
    else:
        parts.append(f"tr.creation_date <= {_ts(RULES.triage_date)}")
        if group in RULES.group_start:
            parts.append(f"tr.creation_date >= {_ts(RULES.group_start[group])}")
        if group == "go":
            parts.append("r.isdiscard = 0")
    if group == "go":
        parts.append(_GO_EXISTS)
    return " AND ".join(parts)


_COLUMNS = """r.refs_key, r.isdiscard, r.year, strftime(r.creation_date, '%m/%d/%Y') AS creation_date,
      r.isreview, t.term AS ref_type, 'ignore supp term' AS supp_status, r.journal, r.title, r.abstract,
      a.accid AS pubmed, s.ap_status, s.gxd_status, s.go_status, s.tumor_status, s.qtl_status"""


def _records_sql(base: str, where: str, preferred: bool = True, label: str = "") -> str:
    only = " AND a.preferred = 1" if preferred else ""
    return f"""
    SELECT DISTINCT {label}{_COLUMNS}
    FROM refs r JOIN {base} tr ON r.refs_key = tr.refs_key
      JOIN parts bd ON r.refs_key = bd.refs_key
      JOIN status s ON r.refs_key = s.refs_key
      JOIN terms t ON r.ref_type_key = t.term_key
      JOIN acc a ON a.object_key = r.refs_key AND a.logicaldb_key = 29 AND a.object_type_key = 1{only}
    WHERE {where}"""


def _day(df: DataFrame) -> DataFrame:
    return df.withColumn("creation_date", F.date_format("creation_date", "MM/dd/yyyy"))


_DAY_SQL = "SELECT refs_key, strftime(creation_date, '%m/%d/%Y') AS creation_date FROM "


@query("omit_set", "SELECT * FROM omit", _CTES)
def _(x: Inputs):
    return selection.omit_set(x.tables(), RULES)


@query("base_set", _DAY_SQL + "base", _CTES)
def _(x: Inputs):
    return _day(selection.base_set(x.tables(), RULES))


@query("backpop_set", _DAY_SQL + "backpop", _CTES)
def _(x: Inputs):
    return _day(selection.base_set(x.tables(), RULES, "backpopulated"))


@query("group_base", _DAY_SQL + "gbase", _CTES)
def _(x: Inputs):
    return _day(selection.base_set(x.tables(), RULES, "group"))


for _name in selection.SUBSETS:
    def _run(x: Inputs, subset=_name):
        return selection.subset_records(x.tables(), RULES, subset, restrict=False)

    query(f"subset_{_name}", _records_sql("base", _WHERE[_name]), _CTES)(_run)


@query("restrict_articles", _records_sql("base", _WHERE["keep_after"] + _RESTRICT), _CTES)
def _(x: Inputs):
    return selection.subset_records(x.tables(), RULES, "keep_after")


@query("limit_refs", _records_sql("base", _WHERE["keep_after"]) + " ORDER BY refs_key, pubmed LIMIT 40", _CTES)
def _(x: Inputs):
    return selection.subset_records(x.tables(), RULES, "keep_after", restrict=False, limit=40)


@query("ref_projection", _records_sql("base", "1 = 1"), _CTES)
def _(x: Inputs):
    return selection.subset_records(x.tables(), RULES, None, restrict=False)


def _group_query(name: str, group: str, search: str) -> None:
    label = "unselected" if search == "unselected_after" else "selected"

    def run(x: Inputs):
        return selection.group_records(x.tables(), RULES, group, search, restrict=False)

    sql = _records_sql("gbase", _search_where(group, search), False, f"'{label}' AS known_class_name, ")
    query(name, sql, _CTES)(run)


_group_query("group_unselected_after", "gxd", "unselected_after")
_group_query("group_selected_after", "ap", "selected_after")
_group_query("group_selected_before", "ap", "selected_before")
_group_query("group_tumor_selected_before", "tumor", "selected_before")
_group_query("go_selected_after", "go", "selected_after")
_group_query("go_selected_before", "go", "selected_before")


def _counts_sql() -> str:
    one = """
    SELECT '{n}' AS subset, count(DISTINCT r.refs_key) AS num
    FROM refs r JOIN base tr ON r.refs_key = tr.refs_key JOIN status s ON r.refs_key = s.refs_key
      JOIN acc a ON a.object_key = r.refs_key AND a.logicaldb_key = 29 AND a.object_type_key = 1 AND a.preferred = 1
    WHERE {w}"""
    parts = [one.format(n=n, w=w) for n, w in _WHERE.items()]
    return " UNION ALL ".join(["SELECT 'omit' AS subset, count(DISTINCT refs_key) AS num FROM omit", *parts])


@query("subset_counts", _counts_sql(), _CTES)
def _(x: Inputs):
    return selection.subset_counts(x.tables(), RULES, restrict=False)


def _group_counts_sql() -> str:
    one = """
    SELECT '{g}' AS grp, '{n}' AS subset, count(DISTINCT r.refs_key) AS num
    FROM refs r JOIN gbase tr ON r.refs_key = tr.refs_key JOIN status s ON r.refs_key = s.refs_key
      JOIN acc a ON a.object_key = r.refs_key AND a.logicaldb_key = 29 AND a.object_type_key = 1
    WHERE {w}"""
    rows = " UNION ALL ".join(
        one.format(g=g, n=selection.search_name(g, s, RULES), w=_search_where(g, s))
        for g in selection.SEARCH_GROUPS for s in selection.SEARCHES
    )
    return f"""SELECT grp, subset, num, round(100.0 * num / sum(num) OVER (PARTITION BY grp), 6) AS percent
    FROM ({rows}) c"""


@query("group_counts", _group_counts_sql(), _CTES)
def _(x: Inputs):
    counts = selection.group_counts(x.tables(), RULES, restrict=False)
    return counts.withColumn("percent", F.round("percent", 6))


# -- text and samples --------------------------------------------------------

_ASSEMBLED = """
    SELECT refs_key, string_agg(text_part, '' ORDER BY CASE text_type WHEN 'body' THEN 1 WHEN 'reference' THEN 2
        WHEN 'author manuscript fig legends' THEN 3 WHEN 'star methods' THEN 4 ELSE 5 END, part_no) AS ext_text
    FROM parts WHERE text_part IS NOT NULL GROUP BY refs_key"""


@query("assemble_text", "SELECT * FROM assembled", {"assembled": _ASSEMBLED})
def _(x: Inputs):
    return texts.assemble_text(x.view("parts"))


@query("stream_assemble_text", "SELECT * FROM assembled", {"assembled": _ASSEMBLED})
def _(x: Inputs):
    """Parts that arrive in two deliveries, assembled by a stream that is restarted between them."""
    inbox, out, state = (scratch_path(x.spark, f"parts-{n}") for n in ("in", "out", "state"))
    parts = x.view("parts").select("refs_key", "part_no", "text_type", "text_part")
    for delivery in (0, 1):
        some = parts.filter(F.pmod(F.xxhash64("refs_key", "part_no", "text_type"), F.lit(2)) == delivery)
        some.write.mode("append").parquet(inbox)
        arriving = assembly.stream_parts(x.spark, inbox, parts.schema)
        append(assembly.assemble_stream(arriving), out, state, once=True).awaitTermination()
    return assembly.latest_texts(x.spark.read.parquet(out))


@query(
    "join_ext_text",
    "SELECT r.refs_key, coalesce(e.ext_text, '') AS ext_text FROM refs r LEFT JOIN assembled e ON r.refs_key = e.refs_key",
    {"assembled": _ASSEMBLED},
)
def _(x: Inputs):
    return texts.join_text(x.view("refs").select("refs_key"), texts.assemble_text(x.view("parts")))


@query("label_samples", """
    SELECT refs_key, CASE WHEN isdiscard = 1 THEN 'discard' ELSE 'keep' END AS triage_class,
      CASE WHEN isdiscard = 0 THEN 'keep' ELSE 'discard' END AS discard_keep FROM refs""")
def _(x: Inputs):
    return x.view("refs").select(
        "refs_key",
        texts.discard_label(F.col("isdiscard")).alias("triage_class"),
        texts.keep_label(F.col("isdiscard")).alias("discard_keep"),
    )


def _clean_sql(column: str) -> str:
    return rf"regexp_replace(replace(replace({column}, ';;', ' '), '|', ' '), '[^\x00-\x7F]', ' ', 'g')"


_SAMPLE_SQL = f"""
    SELECT CASE WHEN r.isdiscard = 1 THEN 'discard' ELSE 'keep' END AS "knownClassName", r.pubmed AS "ID",
      r.creation_date AS "creationDate", CAST(r.year AS VARCHAR) AS year, CAST(r.isreview AS VARCHAR) AS "isReview",
      r.ref_type AS "refType", r.supp_status AS "suppStatus", r.ap_status AS "apStatus",
      r.gxd_status AS "gxdStatus", r.go_status AS "goStatus", r.tumor_status AS "tumorStatus",
      r.qtl_status AS "qtlStatus", replace(r.journal, ' ', '_') AS journal, {_clean_sql('r.title')} AS title,
      {_clean_sql('r.abstract')} AS abstract, {_clean_sql("coalesce(e.ext_text, '')")} AS "extractedText"
    FROM chosen r LEFT JOIN assembled e ON r.refs_key = e.refs_key"""


@query("to_sample", _SAMPLE_SQL,
       _CTES | {"chosen": _records_sql("base", _WHERE["keep_after"]), "assembled": _ASSEMBLED})
def _(x: Inputs):
    return build.triage_subset(x.tables(), "keep_after", RULES, restrict=False)


@query("group_samples", _SAMPLE_SQL.replace(
    """CASE WHEN r.isdiscard = 1 THEN 'discard' ELSE 'keep' END AS "knownClassName\"""",
    """'selected' AS "knownClassName", CASE WHEN r.isdiscard = 0 THEN 'keep' ELSE 'discard' END AS "discardKeep\""""),
       _CTES | {"chosen": _records_sql("gbase", _search_where("go", "selected_after"), False),
                "assembled": _ASSEMBLED})
def _(x: Inputs):
    return build.group_subset(x.tables(), "go", "selected_after", RULES, restrict=False)


@query("backpop_samples", _SAMPLE_SQL,
       _CTES | {"chosen": _records_sql("backpop", "1 = 1"), "assembled": _ASSEMBLED})
def _(x: Inputs):
    return build.triage_subset(x.tables(), None, RULES, "backpopulated", restrict=False)


# -- journals, exports, prefixes ---------------------------------------------


@query("journal_windows", """
    SELECT a.journal, a.n AS num_since_first, b.n AS num_since_second FROM
     (SELECT journal, count(*) AS n FROM refs WHERE creation_date >= TIMESTAMP '1996-01-01' GROUP BY journal) a
     LEFT JOIN (SELECT journal, count(*) AS n FROM refs WHERE creation_date >= TIMESTAMP '2000-06-01'
       GROUP BY journal) b ON a.journal = b.journal""")
def _(x: Inputs):
    return journal_windows(x.view("refs"), "1996-01-01", "2000-06-01")


@query("export_ids", """
    SELECT a.accid AS pubmed, p.haspdf, r.year, r.journal
    FROM refs r JOIN parts p ON r.refs_key = p.refs_key
      JOIN acc a ON a.object_key = r.refs_key AND a.logicaldb_key = 29 AND a.object_type_key = 1
    WHERE r.year >= 1999""")
def _(x: Inputs):
    return selection.known_ids(x.tables(), RULES, 1999)


@query("prefix_uncovered", """
    SELECT DISTINCT concat(p.p_name, ' ', p.p_brand) AS name FROM part p
    WHERE NOT EXISTS (SELECT 1 FROM nation n WHERE starts_with(lower(concat(p.p_name, ' ', p.p_brand)),
      lower(substr('abcdefghijklmnopqrstuvwxyz', CAST(n.n_nationkey AS INT) + 1, 1) || CASE WHEN n.n_nationkey % 2 = 0
        THEN substr('aeiou', CAST(n.n_nationkey AS INT) % 5 + 1, 1) ELSE 'r' END)))""")
def _(x: Inputs):
    key = F.col("n_nationkey")
    second = F.when(key % 2 == 0, F.lit("aeiou").substr(key % 5 + 1, F.lit(1))).otherwise(F.lit("r"))
    first = F.lit("abcdefghijklmnopqrstuvwxyz").substr(key + 1, F.lit(1))
    wildcards = x.table("nation").select(F.concat(first, second, F.lit("*")).alias("prefix"))
    names = x.table("part").select(F.concat_ws(" ", "p_name", "p_brand").alias("name"))
    return selection.not_covered(names, wildcards)


# -- candidates --------------------------------------------------------------


@query("candidate_search", r"""
    SELECT r.refs_key, r.journal, strftime(r.creation_date, '%m/%d/%Y') AS creation_date
    FROM refs r LEFT JOIN assembled e ON r.refs_key = e.refs_key
    WHERE r.journal IN (SELECT concat('J ', c_mktsegment) FROM customer WHERE c_mktsegment <> 'BUILDING')
      AND r.creation_date >= TIMESTAMP '1996-01-01' AND r.creation_date < TIMESTAMP '2000-01-01' AND r.isreview = 0
      AND regexp_matches(concat_ws(' | ', replace(r.title, '7 |', ' Mice |'), r.abstract, e.ext_text), '(?i)\bmice\b')""",
       {"assembled": _ASSEMBLED})
def _(x: Inputs):
    corpus = texts.join_text(x.view("refs"), texts.assemble_text(x.view("parts"))).select(
        "refs_key", "journal", "creation_date", (F.col("isreview") == 0).alias("open_access"),
        F.replace("title", F.lit("7 |"), F.lit(" Mice |")).alias("title"), "abstract",
        F.col("ext_text").alias("text"),
    )
    journals = x.table("customer").filter("c_mktsegment <> 'BUILDING'").select(
        F.concat(F.lit("J "), "c_mktsegment").alias("journal")
    )
    found = candidates.candidate_search(corpus, journals, "1996-01-01", "1999-12-31")
    return _day(found.select("refs_key", "journal", "creation_date"))


TYPES = {"purchase": True, "view": False, "signup": False, "click": False}


def outcomes(x: Inputs) -> DataFrame:
    known = x.table("supplier").select(F.col("s_suppkey").alias("pmid"))
    return candidates.with_outcome(x.view("candidates"), known, TYPES)


OUTCOME_CTE = {
    "outcomes": """
    SELECT c.*, CASE WHEN c.pmid IS NULL THEN 'no_pmid' WHEN s.s_suppkey IS NOT NULL THEN 'in_db'
      WHEN c.type = 'purchase' THEN 'wanted' WHEN c.type IN ('view', 'signup', 'click') THEN 'skipped_type'
      ELSE 'new_type' END AS outcome
    FROM candidates c LEFT JOIN supplier s ON c.pmid = s.s_suppkey"""
}


@query("candidate_outcome", "SELECT pmcid, journal, type, outcome FROM outcomes", OUTCOME_CTE)
def _(x: Inputs):
    return outcomes(x).select("pmcid", "journal", "type", "outcome")


@query("stream_outcome", "SELECT pmcid, journal, type, outcome FROM outcomes", OUTCOME_CTE)
def _(x: Inputs):
    """Candidates that arrive in two deliveries, the second of which repeats the first."""
    inbox, out, state = (scratch_path(x.spark, f"arrivals-{n}") for n in ("in", "out", "state"))
    found = x.view("candidates").select("pmcid", "pmid", "journal", "type")
    known = x.table("supplier").select(F.col("s_suppkey").alias("pmid"))
    for some in (found.filter(F.pmod(F.xxhash64("pmcid"), F.lit(2)) == 0), found):
        some.write.mode("append").parquet(inbox)
        arriving = x.spark.readStream.schema(found.schema).parquet(inbox)
        append(arrivals.outcome_stream(arriving, known, TYPES), out, state, once=True).awaitTermination()
    return x.spark.read.parquet(out).select("pmcid", "journal", "type", "outcome")
