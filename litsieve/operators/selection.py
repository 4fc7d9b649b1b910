"""Which articles belong to which labelled subset.

Every table but ``parts`` has about one row per article. They all join on the
article key, so one hash partitioning serves the whole chain. The many-row
sides (parts, workflow rows, accession rows) are reduced to distinct keys
before they are shuffled, and text is joined last (see ``texts``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.rules import GROUP_COLUMNS, Rules
from litsieve.sources.tables import Tables

STATUS_COLUMNS = list(GROUP_COLUMNS.values())

PROJECTION = [
    "refs_key", "isdiscard", "year", "creation_date", "isreview", "ref_type", "supp_status",
    "journal", "title", "abstract", "pubmed", *STATUS_COLUMNS,
]


def _at(date: str) -> Column:
    return F.to_timestamp(F.lit(date))


# -- base sets ---------------------------------------------------------------


def article_ids(t: Tables, rules: Rules, preferred_only: bool = False) -> DataFrame:
    """Distinct (refs_key, pubmed)."""
    rows = t.acc.filter(
        (F.col("logicaldb_key") == F.lit(rules.logicaldb))
        & (F.col("object_type_key") == F.lit(rules.object_type))
    )
    if preferred_only:
        rows = rows.filter(F.col("preferred") == 1)
    return rows.select(
        F.col("object_key").alias("refs_key"), F.col("accid").alias("pubmed")
    ).distinct()


def with_text(t: Tables) -> DataFrame:
    """Keys of articles that have at least one text part.

    Where ``parts`` has a ``has_text`` flag (see ``sources.tables.flag_text``)
    the texts themselves are not read for this.
    """
    has_text = F.col("has_text") if "has_text" in t.parts.columns else F.col("text_part").isNotNull()
    return t.parts.filter(has_text).select("refs_key").distinct()


def _with_status(refs: DataFrame, t: Tables) -> DataFrame:
    return refs.join(t.status.withColumn("has_status", F.lit(True)), "refs_key", "left")


def _with_omit_flag(articles: DataFrame, t: Tables, rules: Rules, check_id: bool = True) -> DataFrame:
    """Add ``omitted``: the label is doubtful.

    Either indexed for GO by a loader or created by the GOA load, from the start
    date on, with no other group selecting it; or discarded with the tag for
    "mice in references only", whatever its date. Only articles with a status,
    a current workflow row and an ID can be omitted; without ``check_id`` the caller
    joins the IDs anyway.
    """
    current = (
        t.wf_status.filter(F.col("iscurrent") == 1)
        .groupBy("refs_key")
        .agg(
            F.max(
                (F.col("status_key") == F.lit(rules.go_indexed))
                & (F.col("group_key") == F.lit(rules.go_group))
                & (F.col("createdby_key") == F.lit(rules.go_loader))
            ).alias("loader_indexed")
        )
    )
    tagged = (
        t.tags.filter(F.col("tag_key") == F.lit(rules.refs_only_tag))
        .select("refs_key").distinct().withColumn("tagged", F.lit(True))
    )
    if check_id:
        ids = article_ids(t, rules).select("refs_key").distinct()
        articles = articles.join(ids.withColumn("identified", F.lit(True)), "refs_key", "left")
    else:
        articles = articles.withColumn("identified", F.lit(True))

    loaded = F.col("loader_indexed") | (F.col("createdby_key") == F.lit(rules.goa_creator))
    others_unselected = F.lit(True)
    for group in ("ap", "gxd", "tumor", "qtl"):
        others_unselected &= F.col(GROUP_COLUMNS[group]).isin(*rules.not_selected)
    doubtful = (loaded & others_unselected & (F.col("creation_date") >= _at(rules.start_date))) | (
        (F.col("isdiscard") == 1) & F.col("tagged")
    )
    eligible = F.col("has_status") & F.col("loader_indexed").isNotNull() & F.col("identified")
    return (
        articles.join(current, "refs_key", "left")
        .join(tagged, "refs_key", "left")
        .withColumn("omitted", F.coalesce(eligible & doubtful, F.lit(False)))
        .drop("loader_indexed", "tagged", "identified")
    )


def omit_set(t: Tables, rules: Rules) -> DataFrame:
    """Articles left out of training sets, as distinct (refs_key, pubmed)."""
    refs = t.refs.select("refs_key", "createdby_key", "creation_date", "isdiscard")
    return (
        _with_omit_flag(_with_status(refs, t), t, rules, check_id=False)
        .filter("omitted")
        .select("refs_key")
        .join(article_ids(t, rules), "refs_key")
    )


# base name -> condition on the creating user, and whether doubtful articles are left out
BASES: dict[str, tuple[Callable[[Rules], Column], bool]] = {
    "triage": (lambda r: F.col("createdby_key") != F.lit(r.discard_creator), True),
    "backpopulated": (lambda r: F.col("createdby_key") == F.lit(r.discard_creator), True),
    "group": (lambda r: F.lit(True), False),
}


def base_articles(t: Tables, rules: Rules, base: str = "triage", restrict: bool = False,
                  require_text: bool = True) -> DataFrame:
    """Article rows with text that belong to a base, with their status columns.

    Each table is read once and everything joins on the article key, so callers
    can filter the result further and have that reach the scan. A caller that
    joins the text anyway can leave the check for text to that join.
    """
    creator, leave_out = BASES[base]
    refs = t.refs.filter(creator(rules))
    if restrict:
        refs = refs.filter(_restriction(rules))
    if require_text:
        refs = refs.join(with_text(t), "refs_key", "left_semi")
    articles = _with_status(refs, t)
    if leave_out:
        articles = _with_omit_flag(articles, t, rules).filter(~F.col("omitted")).drop("omitted")
    return articles


def base_set(t: Tables, rules: Rules, base: str = "triage") -> DataFrame:
    """(refs_key, creation_date) of the articles of a base."""
    return base_articles(t, rules, base).select("refs_key", "creation_date")


# -- subset conditions -------------------------------------------------------


def selected_by(group: str, rules: Rules) -> Column:
    return F.col(GROUP_COLUMNS[group]).isin(*rules.selected)


def selected_by_any(rules: Rules) -> Column:
    condition = F.lit(False)
    for group in GROUP_COLUMNS:
        condition |= selected_by(group, rules)
    return condition


def _after(date: str) -> Column:
    return F.col("creation_date") > _at(date)


def _until(date: str) -> Column:
    return F.col("creation_date") <= _at(date)


def _from(date: str) -> Column:
    return F.col("creation_date") >= _at(date)


# Subsets may overlap: an article can be both kept and discarded "after", and
# keep_before and keep_tumor share the start date.
SUBSETS: dict[str, Callable[[Rules], Column]] = {
    "discard_after": lambda r: (
        (F.col("isdiscard") == 1) & _after(r.triage_date) & _until(r.end_date)
    ),
    "keep_after": lambda r: selected_by_any(r) & _after(r.triage_date) & _until(r.end_date),
    "keep_before": lambda r: selected_by_any(r) & _from(r.start_date) & _until(r.triage_date),
    "keep_tumor": lambda r: (
        selected_by("tumor", r) & _from(r.tumor_start_date) & _until(r.start_date)
    ),
    "future_test": lambda r: (
        _after(r.end_date) & ((F.col("isdiscard") == 1) | selected_by_any(r))
    ),
}


def go_curated(t: Tables, rules: Rules) -> DataFrame:
    """Keys of articles someone other than the loader selected for GO."""
    return (
        t.wf_status.filter(
            (F.col("group_key") == F.lit(rules.go_group))
            & F.col("status_key").isin(*rules.go_selected)
            & (F.col("createdby_key") != F.lit(rules.go_loader))
        )
        .select("refs_key").distinct()
    )


SEARCHES = ("unselected_after", "selected_after", "selected_before")
SEARCH_GROUPS = ("ap", "go", "gxd", "tumor")


def search_condition(group: str, search: str, rules: Rules) -> Column:
    """Condition of one curation-group search.

    For the GO "selected" searches, column ``go_curated`` must tell whether a
    curator selected the article.
    """
    if group not in SEARCH_GROUPS or search not in SEARCHES:
        raise ValueError(f"{search!r} is not a valid search for group {group!r}")
    if search == "unselected_after":
        by_hand = (F.col("isdiscard") == 1) & (
            F.col("createdby_key") != F.lit(rules.discard_creator)
        )
        rejected = F.col(GROUP_COLUMNS[group]) == rules.rejected
        return _after(rules.triage_date) & (by_hand | rejected)

    condition = selected_by(group, rules)
    if search == "selected_after":
        condition &= _after(rules.triage_date) & (F.col("isdiscard") == 0)
    else:
        condition &= _until(rules.triage_date)
        if group in rules.group_start:
            condition &= _from(rules.group_start[group])
        if group == "go":
            condition &= F.col("isdiscard") == 0
    if group == "go":
        condition &= F.col("go_curated")
    return condition


def search_name(group: str, search: str, rules: Rules) -> str:
    """Report name of a search, e.g. ``AP selected_before 2015-06-01-2017-10-31``."""
    label = {"tumor": "Tumor"}.get(group, group.upper())
    kind = search.replace("unselected", "UNselected")
    start = rules.group_start.get(group) if search == "selected_before" else None
    return f"{label} {kind} " + (f"{start}-" if start else "") + rules.triage_date


# -- article records ---------------------------------------------------------


def _restriction(rules: Rules) -> Column:
    """Peer-reviewed articles that are not reviews."""
    return (F.col("ref_type_key") == F.lit(rules.peer_reviewed)) & (F.col("isreview") != 1)


def _scoped(t: Tables, rules: Rules, base: str, restrict: bool,
            require_text: bool = True) -> DataFrame:
    return base_articles(t, rules, base, restrict, require_text).filter("has_status")


def _project(articles: DataFrame, t: Tables, rules: Rules, preferred_only: bool,
             limit: int, labels: list[Column]) -> DataFrame:
    """Add type and ID; rows are distinct because the joined keys are."""
    out = (
        articles.join(article_ids(t, rules, preferred_only), "refs_key")
        # the one join on another key comes last
        .join(t.terms.select(F.col("term_key").alias("ref_type_key"),
                             F.col("term").alias("ref_type")), "ref_type_key")
    )
    if limit:
        # before any text is joined, and the same rows on every run
        out = out.orderBy("refs_key", "pubmed").limit(limit)
    return out.withColumns(
        {
            "creation_date": F.date_format("creation_date", "MM/dd/yyyy"),
            "supp_status": F.lit(rules.supp_status),
        }
    ).select(*labels, *PROJECTION)


def subset_records(t: Tables, rules: Rules, subset: str | None, base: str = "triage",
                   restrict: bool = True, limit: int = 0, require_text: bool = True) -> DataFrame:
    """Article records of a primary-triage subset (``None``: of the whole base)."""
    articles = _scoped(t, rules, base, restrict, require_text)
    if subset is not None:
        articles = articles.filter(SUBSETS[subset](rules))
    return _project(articles, t, rules, True, limit, [])


def group_records(t: Tables, rules: Rules, group: str, search: str, restrict: bool = True,
                  limit: int = 0, require_text: bool = True) -> DataFrame:
    """Article records of a curation-group search, with the class it implies.

    Unlike the triage subsets these accept any, not only the preferred, ID.
    """
    condition = search_condition(group, search, rules)
    articles = _scoped(t, rules, "group", restrict, require_text)
    if group == "go" and search != "unselected_after":
        articles = articles.join(go_curated(t, rules), "refs_key", "left_semi").withColumn(
            "go_curated", F.lit(True)
        )
    label = "unselected" if search == "unselected_after" else "selected"
    return _project(articles.filter(condition), t, rules, False, limit,
                    [F.lit(label).alias("known_class_name")])


# -- counts ------------------------------------------------------------------


def subset_counts(t: Tables, rules: Rules, restrict: bool = True) -> DataFrame:
    """(subset, num) for the omit set and every subset, all subsets in one pass."""
    articles = _scoped(t, rules, "triage", restrict)
    identified = article_ids(t, rules, True).select("refs_key").distinct()
    typed = t.terms.select(F.col("term_key").alias("ref_type_key"))
    counts = (
        articles.join(typed, "ref_type_key", "left_semi")
        .join(identified, "refs_key", "left_semi")
        .agg(*[F.count_if(cond(rules)).alias(name) for name, cond in SUBSETS.items()])
    )
    omitted = omit_set(t, rules).agg(F.countDistinct("refs_key").alias("num"))
    return counts.unpivot([], list(SUBSETS), "subset", "num").unionByName(
        omitted.select(F.lit("omit").alias("subset"), "num")
    )


def group_counts(t: Tables, rules: Rules, group: str | None = None,
                 restrict: bool = True) -> DataFrame:
    """(group, subset, num, percent of the group's sum) of the group searches."""
    groups = SEARCH_GROUPS if group is None else (group,)
    identified = article_ids(t, rules).select("refs_key").distinct()
    articles = (
        _scoped(t, rules, "group", restrict)
        .join(go_curated(t, rules).withColumn("go_curated", F.lit(True)), "refs_key", "left")
        .withColumn("go_curated", F.coalesce("go_curated", F.lit(False)))
        .join(identified, "refs_key", "left_semi")
    )
    names = [(g, s) for g in groups for s in SEARCHES]
    counts = articles.agg(
        *[F.count_if(search_condition(g, s, rules)).alias(f"{g} {s}") for g, s in names]
    )
    entry = [
        F.struct(
            F.lit(g).alias("grp"),
            F.lit(search_name(g, s, rules)).alias("subset"),
            F.col(f"{g} {s}").alias("num"),
            sum((F.col(f"{g} {x}") for x in SEARCHES), F.lit(0)).alias("total"),
        )
        for g, s in names
    ]
    return counts.select(F.inline(F.array(*entry))).select(
        "grp", "subset", "num",
        F.when(F.col("total") > 0, 100.0 * F.col("num") / F.col("total")).alias("percent"),
    )


# -- ID export ---------------------------------------------------------------


def known_ids(t: Tables, rules: Rules, min_year: int = 2010) -> DataFrame:
    """(pubmed, haspdf, year, journal), one row per text-part flag, journal order."""
    flags = t.parts.select("refs_key", "haspdf")
    return (
        t.refs.filter(F.col("year") >= min_year).select("refs_key", "year", "journal")
        .join(flags, "refs_key")
        .join(article_ids(t, rules), "refs_key")
        .select("pubmed", "haspdf", "year", "journal")
        .orderBy("journal", "pubmed")
    )


# -- names and prefixes ------------------------------------------------------


def not_covered(names: DataFrame, wildcards: DataFrame, name: str = "name",
                wildcard: str = "prefix") -> DataFrame:
    """Distinct names that no wildcard such as ``MCA*`` covers, whatever the case.

    Each name is looked up by its own leading pieces, up to the longest wildcard,
    so this is an equi-join on short keys instead of a comparison of every name
    with every wildcard.
    """
    stems = wildcards.select(F.lower(F.rtrim(F.col(wildcard), F.lit("*"))).alias("stem")).distinct()
    longest = stems.agg(F.max(F.length("stem"))).scalar()
    distinct = names.select(name).distinct()
    lengths = F.sequence(F.lit(0), F.least(F.length(name), F.col("_longest")))
    pieces = distinct.withColumn("_longest", longest).select(
        name,
        F.explode(
            F.transform(lengths, lambda n: F.lower(F.col(name).substr(F.lit(1), n)))
        ).alias("stem"),
    )
    covered = pieces.join(stems, "stem", "left_semi").select(name).distinct()
    return distinct.join(covered, name, "left_anti")
