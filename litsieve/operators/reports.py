"""Counting reports: journals, prediction quality, curation groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from litsieve.rules import GROUP_COLUMNS, Rules


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 on an empty whole."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def journal_distribution(df: DataFrame, positive: Column, journal: str = "journal") -> DataFrame:
    """Articles per journal and class with their share of each column, and totals.

    Counts are reduced map-side, so a journal with most of the articles costs no
    more than any other. The totals come from the per-journal counts through a
    one-row subquery.
    """
    counts = df.groupBy(F.col(journal).alias("journal")).agg(
        F.count("*").alias("articles"),
        F.count_if(positive).alias("pos"),
    ).withColumn("neg", F.col("articles") - F.col("pos"))
    columns = ("articles", "pos", "neg")
    totals = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
    whole = totals.select(F.struct(*columns)).scalar()
    rows = counts.withColumn("whole", whole).select(
        "journal",
        *[
            c
            for name in columns
            for c in (
                F.col(name),
                (100.0 * ratio(F.col(name), F.col(f"whole.{name}"))).alias(f"{name}_pct"),
            )
        ],
    )
    bottom = totals.select(
        F.lit("Totals").alias("journal"),
        *[c for name in columns for c in (F.col(name), F.lit(100.0).alias(f"{name}_pct"))],
    )
    return rows.unionByName(bottom)


def journal_windows(refs: DataFrame, since: str = "2010-01-01",
                    recent: str = "2016-10-01") -> DataFrame:
    """Articles per journal since two dates, in one pass; no recent ones gives NULL."""
    date = F.col("creation_date")
    start = F.to_timestamp(F.lit(since))
    recent_count = F.count_if(
        F.col("journal").isNotNull() & (date >= F.to_timestamp(F.lit(recent)))
    )
    return (
        refs.filter(date >= start)
        .groupBy("journal")
        .agg(
            F.count("*").alias("num_since_first"),
            F.nullif(recent_count, F.lit(0).cast("long")).alias("num_since_second"),
        )
    )


def journal_set(df: DataFrame, journal: str = "journal") -> DataFrame:
    return df.select(F.col(journal).alias("journal")).distinct()


# -- prediction quality ------------------------------------------------------


def _confusion(keep: str, true_class: str, pred_class: str) -> dict[str, Column]:
    is_keep, said_keep = F.col(true_class) == keep, F.col(pred_class) == keep
    return {
        "papers": F.count("*"),
        "tp": F.count_if(is_keep & said_keep),
        "fp": F.count_if(~is_keep & said_keep),
        "fn": F.count_if(is_keep & ~said_keep),
        "tn": F.count_if(~is_keep & ~said_keep),
    }


def _with_ratios(df: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return df.withColumns(
        {
            "p": ratio(tp, tp + fp),
            "r": ratio(tp, tp + fn),
            "npv": ratio(tn, tn + fn),
        }
    )


def confusion(predictions: DataFrame, by: str | None = None, keep: str = "keep",
              true_class: str = "true_class", pred_class: str = "pred_class") -> DataFrame:
    """Confusion counts, precision, recall and NPV of all papers or per subset."""
    cells = [c.alias(n) for n, c in _confusion(keep, true_class, pred_class).items()]
    grouped = predictions.groupBy(by) if by else predictions.groupBy()
    return _with_ratios(grouped.agg(*cells))


def recall_by_group(predictions: DataFrame, rules: Rules, keep: str = "keep",
                    columns: dict[str, str] | None = None, true_class: str = "true_class",
                    pred_class: str = "pred_class") -> DataFrame:
    """Papers, papers predicted keep and recall per curation group, and Totals.

    A paper counts in every group that selected it; groups are conditions of one
    aggregate, so no row is copied. A group's papers include true discards, its
    recall does not.
    """
    columns = columns or dict(GROUP_COLUMNS)
    selected = [s.lower() for s in rules.selected]
    member = {g: F.lower(F.col(c)).isin(*selected) for g, c in columns.items()}
    member["Totals"] = F.lit(True)
    is_keep, said_keep = F.col(true_class) == keep, F.col(pred_class) == keep
    cells = []
    for g, m in member.items():
        papers = m & is_keep if g == "Totals" else m
        cells += [
            F.count_if(papers).alias(f"{g}_papers"),
            F.count_if(m & is_keep & said_keep).alias(f"{g}_tp"),
            F.count_if(m & is_keep & ~said_keep).alias(f"{g}_fn"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(g).alias("grp"),
                F.col(f"{g}_papers").alias("papers"),
                F.col(f"{g}_tp").alias("predicted_keep"),
                ratio(F.col(f"{g}_tp"), F.col(f"{g}_tp") + F.col(f"{g}_fn")).alias("recall"),
            )
            for g in member
        ]
    )
    return predictions.agg(*cells).select(F.inline(rows))


def f_beta(p: Column, r: Column, beta: float = 2.0) -> Column:
    b2 = beta * beta
    return F.when(p + r == 0, F.lit(0.0)).otherwise((1 + b2) * p * r / (b2 * p + r))


def class_report(predictions: DataFrame, by: str = "split", beta: float = 2.0, **names) -> DataFrame:
    """Precision, recall, F1 and support of both classes, and F-beta and NPV, per split."""
    p, r, npv = F.col("p"), F.col("r"), F.col("npv")
    tn, fp = F.col("tn"), F.col("fp")
    specificity = ratio(tn, tn + fp)
    return confusion(predictions, by, **names).select(
        by, "tp", "fn", "fp", "tn",
        p.alias("keep_precision"), r.alias("keep_recall"),
        f_beta(p, r, 1.0).alias("keep_f1"), (F.col("tp") + F.col("fn")).alias("keep_support"),
        npv.alias("discard_precision"), specificity.alias("discard_recall"),
        f_beta(npv, specificity, 1.0).alias("discard_f1"),
        (tn + fp).alias("discard_support"),
        f_beta(p, r, beta).alias("f_beta"),
    )


def error_examples(predictions: DataFrame, key: str, keep: str = "keep", n: int = 5,
                   true_class: str = "true_class", pred_class: str = "pred_class") -> DataFrame:
    """The first n false positives and false negatives by ID, with their totals.

    The rank bound also applies before the shuffle, so a kind with most of the
    rows passes on n rows per task.
    """
    is_keep, said_keep = F.col(true_class) == keep, F.col(pred_class) == keep
    kind = F.when(~is_keep & said_keep, "FP").when(is_keep & ~said_keep, "FN")
    errors = predictions.select(kind.alias("kind"), key).filter("kind IS NOT NULL")
    totals = errors.groupBy("kind").agg(F.count("*").alias("total"))
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(key))
    first = errors.withColumn("rank", rank).filter(F.col("rank") <= n).drop("rank")
    return first.join(totals, "kind")


def alphabetical_probe(terms: DataFrame, term: str = "term", n: int = 10) -> DataFrame:
    """(part, pos, term): the first, middle and last n of a set of distinct terms.

    Positions come from a count per leading character, which is small however
    many terms there are, and a rank among the terms that share it; no task
    sorts them all.
    """
    lead = F.substring(term, 1, 2)
    keyed = terms.select(term, lead.alias("lead"))
    sizes = keyed.groupBy("lead").agg(F.count("*").alias("n"))
    before = Window.orderBy("lead").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "lead",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    rank = F.row_number().over(Window.partitionBy("lead").orderBy(term))
    placed = keyed.withColumn("rank", rank).join(offsets, "lead").select(
        term, (F.col("offset") + F.col("rank")).alias("pos"), "total"
    )
    middle = F.floor(F.col("total") / 2) - n // 2
    part = (
        F.array_compact(
            F.array(
                F.when(F.col("pos") <= n, F.lit("first")),
                F.when((F.col("pos") > middle) & (F.col("pos") <= middle + n), F.lit("middle")),
                F.when(F.col("pos") > F.col("total") - n, F.lit("last")),
            )
        )
    )
    return placed.select(F.explode(part).alias("part"), "pos", term)
