"""Reports, splits and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from litsieve.operators import candidates, reports, running, splits
from litsieve.plans.backfill import backfill
from litsieve.plans.catalog.registry import query
from litsieve.plans.catalog.selection import OUTCOME_CTE, TYPES, outcomes
from litsieve.plans.catalog.views import RULES, Inputs
from litsieve.rules import GROUP_COLUMNS
from litsieve.schema import PRIM_TRIAGE, omit_rejects, set_reject, validate_class
from litsieve.sources.lists import journal_names
from litsieve.sources.samples import union_samples

_SELECTED = "('Chosen', 'Indexed', 'Full-coded')"


def _round(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0.0 ELSE ({part}) * 1.0 / ({whole}) END"


# -- journals ----------------------------------------------------------------


@query("journal_dist", """
    SELECT journal, articles, round(articles_pct, 6) AS articles_pct, pos, round(pos_pct, 6) AS pos_pct, neg,
      round(neg_pct, 6) AS neg_pct FROM
    (SELECT journal, n AS articles, 100.0 * n / sum(n) OVER () AS articles_pct, p AS pos,
       100.0 * p / sum(p) OVER () AS pos_pct, n - p AS neg, 100.0 * (n - p) / sum(n - p) OVER () AS neg_pct
     FROM (SELECT journal, count(*) AS n, count(*) FILTER (isdiscard = 0) AS p FROM refs GROUP BY journal) c
     UNION ALL
     SELECT 'Totals', count(*), 100.0, count(*) FILTER (isdiscard = 0), 100.0, count(*) FILTER (isdiscard = 1), 100.0
     FROM refs) d""")
def _(x: Inputs):
    dist = reports.journal_distribution(x.view("refs"), F.col("isdiscard") == 0)
    return _round(dist, "articles_pct", "pos_pct", "neg_pct")


@query("journal_set", "SELECT DISTINCT source AS journal FROM documents")
def _(x: Inputs):
    return reports.journal_set(x.table("documents"), "source")


@query("norm_journals", """
    SELECT DISTINCT replace(lower(trim(concat('  J of ', p_name, ' ', p_brand, ' '))), ' ', '_') AS journal FROM part""")
def _(x: Inputs):
    lines = x.table("part").select(
        F.concat(F.lit("  J of "), "p_name", F.lit(" "), "p_brand", F.lit(" ")).alias("value")
    )
    return journal_names(lines)


# -- prediction quality ------------------------------------------------------

_CELLS = """count(*) AS papers,
    count(*) FILTER (true_class = 'keep' AND pred_class = 'keep') AS tp,
    count(*) FILTER (true_class <> 'keep' AND pred_class = 'keep') AS fp,
    count(*) FILTER (true_class = 'keep' AND pred_class <> 'keep') AS fn,
    count(*) FILTER (true_class <> 'keep' AND pred_class <> 'keep') AS tn"""


@query("confusion", f"""
    SELECT journal, papers, tp, fp, fn, tn, round({_ratio('tp', 'tp + fp')}, 6) AS p,
      round({_ratio('tp', 'tp + fn')}, 6) AS r, round({_ratio('tn', 'tn + fn')}, 6) AS npv
    FROM (SELECT journal, {_CELLS} FROM pred GROUP BY journal) c""")
def _(x: Inputs):
    return _round(reports.confusion(x.view("pred"), "journal"), "p", "r", "npv")


@query("recall_by_group", " UNION ALL ".join(
    f"""SELECT '{g}' AS grp, papers, tp AS predicted_keep, round({_ratio('tp', 'tp + fn')}, 6) AS recall
    FROM (SELECT {_CELLS} FROM pred WHERE {c} IN {_SELECTED}) x""" for g, c in GROUP_COLUMNS.items()
) + f""" UNION ALL SELECT 'Totals', tp + fn, tp, round({_ratio('tp', 'tp + fn')}, 6)
    FROM (SELECT {_CELLS} FROM pred) x""")
def _(x: Inputs):
    return _round(reports.recall_by_group(x.view("pred"), RULES), "recall")


_PRED_SPLIT = "CASE WHEN createdby_key < 4 THEN 'val' ELSE 'train' END"


@query("class_report", f"""
    SELECT split, tp, fn, fp, tn, round(kp, 6) AS keep_precision, round(kr, 6) AS keep_recall,
      round({_ratio('2 * kp * kr', '(kp + kr)')}, 6) AS keep_f1, tp + fn AS keep_support,
      round(dp, 6) AS discard_precision, round(dr, 6) AS discard_recall,
      round({_ratio('2 * dp * dr', '(dp + dr)')}, 6) AS discard_f1, tn + fp AS discard_support,
      round({_ratio('5 * kp * kr', '(4 * kp + kr)')}, 6) AS f_beta
    FROM (SELECT *, {_ratio('tp', '(tp + fp)')} AS kp, {_ratio('tp', '(tp + fn)')} AS kr,
            {_ratio('tn', '(tn + fn)')} AS dp, {_ratio('tn', '(tn + fp)')} AS dr
          FROM (SELECT {_PRED_SPLIT} AS split, {_CELLS} FROM pred GROUP BY 1) c) d""")
def _(x: Inputs):
    pred = x.view("pred").withColumn("split", F.expr(_PRED_SPLIT))
    ratios = [f"{c}_{m}" for c in ("keep", "discard") for m in ("precision", "recall", "f1")]
    return _round(reports.class_report(pred), *ratios, "f_beta")


@query("fp_fn_examples", """
    (SELECT 'FP' AS kind, id, (SELECT count(*) FROM pred WHERE true_class <> 'keep' AND pred_class = 'keep') AS total
     FROM pred WHERE true_class <> 'keep' AND pred_class = 'keep' ORDER BY id LIMIT 5)
    UNION ALL
    (SELECT 'FN', id, (SELECT count(*) FROM pred WHERE true_class = 'keep' AND pred_class <> 'keep')
     FROM pred WHERE true_class = 'keep' AND pred_class <> 'keep' ORDER BY id LIMIT 5)""")
def _(x: Inputs):
    return reports.error_examples(x.view("pred"), "id")


# -- samples as sets ---------------------------------------------------------


@query("omit_rejects", """
    SELECT doc_id, CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'low quality' ELSE '' END AS reject_reason
    FROM labels WHERE toxic = 0 AND quality <> 0""")
def _(x: Inputs):
    marked = set_reject(x.table("labels"), F.col("toxic") == 1, "toxic")
    marked = set_reject(marked, F.col("quality") == 0, "low quality")
    return omit_rejects(marked).select("doc_id", "reject_reason")


@query("class_validate", """
    SELECT refs_key, regexp_replace(l, '^;', '') AS "knownClassName",
      NOT regexp_replace(l, '^;', '') IN ('discard', 'keep') AS reject,
      CASE WHEN regexp_replace(l, '^;', '') IN ('discard', 'keep') THEN ''
        ELSE 'invalid class name: ' || regexp_replace(l, '^;', '') END AS reject_reason
    FROM (SELECT refs_key, CASE refs_key % 4 WHEN 0 THEN 'bad' WHEN 1 THEN ';keep' WHEN 2 THEN ';discard'
            ELSE 'keep' END AS l FROM refs) x""")
def _(x: Inputs):
    label = F.expr("CASE refs_key % 4 WHEN 0 THEN 'bad' WHEN 1 THEN ';keep' WHEN 2 THEN ';discard' ELSE 'keep' END")
    refs = x.view("refs").select("refs_key", label.alias("knownClassName"))
    return validate_class(refs, PRIM_TRIAGE, quarantine=True)


@query("union_samples", """
    SELECT CAST(refs_key AS STRING) AS "ID", journal, CASE WHEN isdiscard = 1 THEN 'discard' ELSE 'keep' END AS "knownClassName"
    FROM refs WHERE createdby_key < 10
    UNION ALL
    SELECT CAST(refs_key AS STRING), journal, CASE WHEN isdiscard = 1 THEN 'discard' ELSE 'keep' END
    FROM refs WHERE createdby_key >= 5""")
def _(x: Inputs):
    label = F.when(F.col("isdiscard") == 1, "discard").otherwise("keep")
    refs = x.view("refs").withColumns({"ID": F.col("refs_key"), "knownClassName": label})
    sets = [
        (PRIM_TRIAGE.conform(refs.filter(c)), PRIM_TRIAGE)
        for c in ("createdby_key < 10", "createdby_key >= 5")
    ]
    return union_samples(sets).select("ID", "journal", "knownClassName")


# -- splits ------------------------------------------------------------------


def _draw(key: str, seed: int) -> str:
    return f"(('0x' || substr(md5(concat('{seed}:', {key})), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


_LABELLED = "SELECT refs_key, journal, isdiscard, createdby_key, creation_date FROM refs"


@query("split_random", f"""
    SELECT refs_key, {_draw('refs_key', 7)} < 0.2 AS retained FROM refs""")
def _(x: Inputs):
    return splits.split_random(
        x.view("refs").select("refs_key"), "refs_key", 0.2, 7
    )


@query("split_only_monitored", f"""
    SELECT d.doc_id, m.journal IS NOT NULL AND {_draw('d.doc_id', 7)} < 0.5 AS retained
    FROM documents d LEFT JOIN monitored m ON lower(d.source) = m.journal""")
def _(x: Inputs):
    docs = x.table("documents").select("doc_id", F.col("source").alias("journal"))
    return splits.split_random(
        docs, "doc_id", 0.5, 7, x.view("monitored")
    ).select("doc_id", "retained")


_AFTER = "creation_date > TIMESTAMP '1998-10-31'"
_THREE = f"""CASE WHEN {_AFTER} AND {_draw('refs_key', 3)} < 0.15 THEN 'test'
    WHEN {_AFTER} AND {_draw('refs_key', 4)} < 0.235 THEN 'val' ELSE 'train' END"""


def _three_way(x: Inputs) -> DataFrame:
    after = F.col("creation_date") > F.to_timestamp(F.lit("1998-10-31"))
    return splits.split_three_way(
        x.view("refs"), "refs_key", after, seed=3
    )


@query("split_three_way", f"SELECT refs_key, {_THREE} AS split FROM refs")
def _(x: Inputs):
    return _three_way(x).select("refs_key", "split")


@query("class_balance", f"""
    SELECT split, count(*) AS samples, count(*) FILTER (isdiscard = 0) AS positive,
      count(*) FILTER (isdiscard = 1) AS negative,
      round(100.0 * count(*) FILTER (isdiscard = 0) / count(*), 6) AS positive_pct
    FROM (SELECT isdiscard, {_THREE} AS split FROM refs) x GROUP BY split""")
def _(x: Inputs):
    return _round(splits.class_balance(_three_way(x), F.col("isdiscard") == 0), "positive_pct")


@query("split_summary", f"""
    SELECT side, refs, pos, neg, round(100.0 * pos / refs, 6) AS pos_pct, round(100.0 * neg / refs, 6) AS neg_pct,
      journals, round(100.0 * refs / (SELECT count(*) FROM refs), 6) AS input_pct
    FROM (SELECT CASE WHEN grouping(retained) = 1 THEN 'input' WHEN retained THEN 'retained' ELSE 'leftover' END AS side,
            count(*) AS refs, count(*) FILTER (isdiscard = 0) AS pos, count(*) FILTER (isdiscard = 1) AS neg,
            count(DISTINCT journal) AS journals
          FROM (SELECT *, {_draw('refs_key', 7)} < 0.2 AS retained FROM refs) x
          GROUP BY GROUPING SETS ((), (retained))) y""")
def _(x: Inputs):
    split = splits.split_random(x.view("refs"), "refs_key", 0.2, 7)
    summary = splits.split_summary(split, F.col("isdiscard") == 0)
    return _round(summary, "pos_pct", "neg_pct", "input_pct")


@query("small_build", f"""
    SELECT subset, refs_key FROM
      (SELECT subset, refs_key, row_number() OVER (PARTITION BY subset ORDER BY {_draw('refs_key', 1)}, refs_key) AS k
       FROM (SELECT refs_key, CASE WHEN isdiscard = 1 THEN 'discard' ELSE 'keep' END
               || CASE WHEN {_AFTER} THEN '_after' ELSE '_before' END AS subset FROM refs) s) t
    WHERE k <= CASE subset WHEN 'discard_after' THEN 160 WHEN 'keep_after' THEN 80 ELSE 40 END""")
def _(x: Inputs):
    after = F.col("creation_date") > F.to_timestamp(F.lit("1998-10-31"))
    subset = F.concat(
        F.when(F.col("isdiscard") == 1, "discard").otherwise("keep"),
        F.when(after, "_after").otherwise("_before"),
    )
    refs = x.view("refs").select("refs_key", subset.alias("subset"))
    return splits.small_build(
        refs, "refs_key", "subset", {"discard_after": 160, "keep_after": 80}, seed=1
    )


# -- candidates --------------------------------------------------------------


@query("outcome_report", """
    SELECT *, found - skipped_type - new_type - in_db - no_pdf - no_pmid AS matching FROM
    (SELECT journal, count(*) AS found,
      count(*) FILTER (outcome = 'no_pmid') AS no_pmid, count(*) FILTER (outcome = 'in_db') AS in_db,
      count(*) FILTER (outcome = 'skipped_type') AS skipped_type, count(*) FILTER (outcome = 'new_type') AS new_type,
      count(*) FILTER (outcome = 'wanted' AND NOT has_pdf) AS no_pdf,
      count(*) FILTER (outcome = 'wanted' AND NOT has_body) AS no_body,
      count(*) FILTER (outcome = 'wanted' AND has_pdf) AS pdf_written,
      count(*) FILTER (outcome = 'wanted') AS text_written
     FROM outcomes GROUP BY journal) x""", OUTCOME_CTE)
def _(x: Inputs):
    return candidates.outcome_report(outcomes(x))


_BACKFILL_CTES = {
    "picked_pdf": r"""
    SELECT DISTINCT archive_id AS pmcid FROM files
    WHERE regexp_matches(path, '(?i)/(?:.*main|.*article[-_]*[0-9]*)\.pdf$')
       OR (size > 0 AND NOT regexp_matches(path, '(?i)/(?:.*sup.*|.*sd.*|.*s[0-9]+|.*data.*|.*fig.*)\.pdf$'))""",
    "judged_all": """
    SELECT o.pmcid, o.journal, o.outcome, o.has_body, p.pmcid IS NOT NULL AS has_pdf
    FROM outcomes o LEFT JOIN picked_pdf p ON o.pmcid = p.pmcid""",
}


@query("backfill_report", """
    SELECT *, found - skipped_type - new_type - in_db - no_pdf - no_pmid AS matching FROM
    (SELECT journal, count(*) AS found,
      count(*) FILTER (outcome = 'no_pmid') AS no_pmid, count(*) FILTER (outcome = 'in_db') AS in_db,
      count(*) FILTER (outcome = 'skipped_type') AS skipped_type, count(*) FILTER (outcome = 'new_type') AS new_type,
      count(*) FILTER (outcome = 'wanted' AND NOT has_pdf) AS no_pdf,
      count(*) FILTER (outcome = 'wanted' AND NOT has_body) AS no_body,
      count(*) FILTER (outcome = 'wanted' AND has_pdf) AS pdf_written,
      count(*) FILTER (outcome = 'wanted') AS text_written
     FROM judged_all GROUP BY journal) x""", OUTCOME_CTE | _BACKFILL_CTES)
def _(x: Inputs):
    """The whole side job: article outcomes with the main files of their archives."""
    articles = x.view("candidates").drop("has_pdf").withColumn("text", F.lit(""))
    known = x.table("supplier").select(F.col("s_suppkey").alias("pmid"))
    files = x.view("files").withColumnRenamed("archive_id", "pmcid")
    return backfill(articles, known, files, TYPES).report


@query("outcome_examples", """
    SELECT journal, outcome, type, num, array_to_string(ids[1:6], ', ') AS examples FROM
    (SELECT journal, outcome, type, count(*) AS num, list(CAST(id AS VARCHAR) ORDER BY id) AS ids FROM
      (SELECT journal, outcome, CASE WHEN outcome IN ('skipped_type', 'new_type') THEN type END AS type,
         CASE WHEN outcome = 'in_db' THEN pmid ELSE pmcid END AS id
       FROM outcomes WHERE outcome <> 'wanted'
       UNION ALL SELECT journal, 'no_pdf', NULL, pmid FROM outcomes WHERE outcome = 'wanted' AND NOT has_pdf
       UNION ALL SELECT journal, 'no_body', NULL, pmid FROM outcomes WHERE outcome = 'wanted' AND NOT has_body) l
     GROUP BY journal, outcome, type) g""", OUTCOME_CTE)
def _(x: Inputs):
    return candidates.outcome_examples(outcomes(x))


_PICK_CTES = {
    "named": r"""
    SELECT *, regexp_extract(path, '([^/]*)\.pdf$', 1) AS base FROM files""",
    "judged": r"""
    SELECT *, regexp_matches(base, '(?i)^(?:.*main|.*article[-_]*[0-9]*|nihms[-_]*[0-9]+|ncomms[0-9]+|onc[0-9]+a)$') AS m,
      regexp_matches(base, '(?i)^(?:.*sup.*|.*sd.*|.*s[0-9]+$|.*data.*|.*fig.*|.*table.*|.*video.*|bj.*add$)') AS s
    FROM named""",
    # the running maximum over candidates, in listing order
    "walked": """
    SELECT *, size > coalesce(max(size) OVER (PARTITION BY archive_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING
        AND 1 PRECEDING), 0) AS moved
    FROM judged WHERE NOT m AND NOT s""",
    "picked": """
    SELECT a.archive_id, coalesce(m.pos, w.pos) AS pos,
      CASE WHEN m.pos IS NOT NULL THEN 'm' WHEN w.n = 1 THEN 'o' WHEN w.n > 1 THEN 's' END AS reason
    FROM (SELECT DISTINCT archive_id FROM files) a
      LEFT JOIN (SELECT archive_id, min(pos) AS pos FROM judged WHERE m GROUP BY archive_id) m ON a.archive_id = m.archive_id
      LEFT JOIN (SELECT archive_id, max(pos) AS pos, count(*) AS n FROM walked WHERE moved GROUP BY archive_id) w
        ON a.archive_id = w.archive_id""",
}


@query("main_file_pick", """
    SELECT p.archive_id, f.path, p.pos, p.reason FROM picked p
      LEFT JOIN files f ON p.archive_id = f.archive_id AND p.pos = f.pos""", _PICK_CTES)
def _(x: Inputs):
    return candidates.main_file(x.view("files"))


@query("main_file_log", """
    SELECT p.archive_id, p.reason, c.path AS chosen, o.pos AS other_pos, o.base || '.pdf' AS other
    FROM picked p
      LEFT JOIN files c ON p.archive_id = c.archive_id AND p.pos = c.pos
      LEFT JOIN named o ON p.archive_id = o.archive_id AND o.pos <> p.pos AND (p.reason <> 'm' OR o.pos < p.pos)""",
       _PICK_CTES)
def _(x: Inputs):
    return candidates.main_file_log(x.view("files"))


@query("running_largest", """
    SELECT archive_id, pos, size, max(size) OVER (PARTITION BY archive_id ORDER BY pos) AS largest FROM files""")
def _(x: Inputs):
    """The largest file so far of every archive's listing, in order."""
    rows = running.running(x.view("files").select("archive_id", "pos", "size"), "archive_id", ["pos"], "size", "largest")
    return rows.select("archive_id", "pos", "size", "largest")


@query("running_total", """
    SELECT archive_id, pos, sum(size) OVER (ORDER BY archive_id, pos) AS total FROM files""")
def _(x: Inputs):
    """All archives as one listing: a single group that no task sees whole."""
    rows = x.view("files").select("archive_id", "pos", "size").withColumn("one", F.lit(1))
    rows = running.running(rows, "one", ["archive_id", "pos"], "size", "total", "sum")
    return rows.select("archive_id", "pos", "total")
