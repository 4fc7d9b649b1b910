"""Text operators over whole article texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from litsieve.functions import clean, figures, rewrite, stem
from litsieve.operators import preprocess as pre
from litsieve.plans.catalog.registry import query
from litsieve.plans.catalog.stemming import stem_ctes
from litsieve.plans.catalog.views import Inputs
from litsieve.streaming import preprocess as stream
from litsieve.session import scratch_path

# ASCII part of the whitespace class; the checked texts are ASCII
_S, _NS = r"[\x09-\x0D\x1C-\x20]", r"[^\x09-\x0D\x1C-\x20]"
_URL = rf"(?i)\b(?:https?://|www[.]|doi){_NS}*"
_FIELDS = ("title", "abstract", "extractedText")


def _each(expr: str, fields=_FIELDS) -> str:
    """The SQL expression for every text field, ``{}`` standing for the field."""
    return ", ".join(f'{expr.replace("{}", chr(34) + f + chr(34))} AS "{f}"' for f in fields)


def _scrub(c: str) -> str:
    return rf"regexp_replace(replace(replace({c}, ';;', ' '), '|', ' '), '[^\x00-\x7F]', ' ', 'g')"


# -- cleaning ----------------------------------------------------------------


@query("clean_text", f"SELECT doc_id, {_scrub('text')} AS text FROM corpus")
def _(x: Inputs):
    return x.view("corpus").select("doc_id", clean.clean_text(F.col("text")).alias("text"))


@query("truncate_ingest",
       f"SELECT doc_id, {_scrub('replace(substr(text, 1, 200), chr(10), chr(32))')} || chr(10) AS text FROM corpus")
def _(x: Inputs):
    return x.view("corpus").select("doc_id", clean.ingest_text(F.col("text"), 200).alias("text"))


@query("truncate_text", """
    SELECT "ID", replace(substr(title, 1, 10), chr(10), ' ') AS title,
      replace(substr(abstract, 1, 20), chr(10), ' ') AS abstract,
      replace(substr("extractedText", 1, 20), chr(10), ' ') || chr(10) AS "extractedText" FROM samples""")
def _(x: Inputs):
    return pre.preprocess(x.view("samples"), ["truncateText"]).select("ID", *_FIELDS)


@query("remove_text", """
    SELECT "ID", replace(substr(title, 1, 10), chr(10), ' ') AS title, 'abstract...' AS abstract,
      'extracted text...' || chr(10) AS "extractedText" FROM samples""")
def _(x: Inputs):
    return pre.preprocess(x.view("samples"), ["removeText"]).select("ID", *_FIELDS)


_DOCUMENT = 'concat(title, chr(10), abstract, chr(10), "extractedText")'


@query("make_document", f'SELECT "ID", {_DOCUMENT} AS document FROM samples')
def _(x: Inputs):
    samples = x.view("samples")
    return samples.select("ID", pre.document(samples).alias("document"))


@query("text_lengths", """SELECT "ID", CAST(length(abstract) AS INT) AS "abstractLen", CAST(length("extractedText") AS INT) AS "textLen"
    FROM samples""")
def _(x: Inputs):
    return pre.with_lengths(x.view("samples")).select("ID", "abstractLen", "textLen")


@query("remove_urls", f"""SELECT "ID", {_each(f"lower(regexp_replace({{}}, '{_URL}', '', 'g'))")} FROM samples""")
def _(x: Inputs):
    return pre.preprocess(x.view("samples"), ["removeURLs"]).select("ID", *_FIELDS)


_PER_LINE = r"array_to_string(list_transform(regexp_extract_all({}, '\w+'), lambda t: t || chr(10)), '')"


@query("token_per_line", f'SELECT "ID", {_each(_PER_LINE)} FROM samples')
def _(x: Inputs):
    return pre.preprocess(x.view("samples"), ["tokenPerLine"]).select("ID", *_FIELDS)


_TOKENS = r"array_to_string(list_transform(regexp_extract_all(lower({}), '\b[a-z_]\w+\b'), lambda t: ' ' || t), '')"


@query("clean_tokens", f'SELECT "ID", {_each(_TOKENS)} FROM samples')
def _(x: Inputs):
    return pre.on_fields(clean.clean_tokens)(x.view("samples")).select("ID", *_FIELDS)


@query("preprocess_chain",
       'SELECT "ID", ' + _each(_PER_LINE.replace("{}", f"lower(regexp_replace({{}}, '{_URL}', '', 'g'))"))
       + " FROM samples")
def _(x: Inputs):
    return pre.preprocess(x.view("samples"), ["removeURLs", "tokenPerLine"]).select("ID", *_FIELDS)


@query("journal_feature", f"""
    SELECT "ID", {_DOCUMENT} || ' journal__' || replace(lower(trim(journal)), ' ', '_') AS document FROM samples""")
def _(x: Inputs):
    samples = x.view("samples")
    return samples.select(
        "ID", clean.journal_feature(pre.document(samples), F.col("journal")).alias("document")
    )


# -- figure passages ---------------------------------------------------------

_MENTION = r"\b(?:fig(?:ure)?|table)s?\b"
_LEGEND = rf"(?i)^\b(?:(?:(?:supp\w*|online|extended{_S}data){_S})?fig(?:ure)?|table)\b"
_PARAS = rf"""list_transform(string_split(text, chr(10) || chr(10)),
    lambda p: regexp_replace(p, '^{_S}+|{_S}+$', '', 'g'))"""
_PARA_CTE = {"paras": f"SELECT doc_id, {_PARAS} AS ps FROM clean"}
_BLANK = "chr(10) || chr(10)"


@query("paragraphs", "SELECT doc_id, CAST(unnest(range(len(ps))) AS INT) AS pos, unnest(ps) AS paragraph FROM paras",
       _PARA_CTE)
def _(x: Inputs):
    return x.view("clean").select(
        "doc_id", F.posexplode(figures.paragraphs(F.col("text"))).alias("pos", "paragraph")
    )


def _kept(pattern: str) -> str:
    return f"""SELECT doc_id, array_to_string(list_filter(ps, lambda p: regexp_matches(p, '{pattern}')), {_BLANK})
    AS text FROM paras"""


@query("fig_legends", _kept(_LEGEND), _PARA_CTE)
def _(x: Inputs):
    return x.view("clean").select("doc_id", figures.figure_text(F.col("text"), "legends").alias("text"))


@query("fig_paragraphs", _kept("(?i)" + _MENTION), _PARA_CTE)
def _(x: Inputs):
    return x.view("clean").select(
        "doc_id", figures.figure_text(F.col("text"), "legParagraphs").alias("text")
    )


def _windows_ctes(n: int) -> dict[str, str]:
    """Passages per paragraph, gaps between the windows of one paragraph as line breaks."""
    edge = "chr(64976)"
    return _PARA_CTE | {
        "para": """
            SELECT doc_id, unnest(range(len(ps))) AS pos, unnest(ps) AS p FROM paras""",
        "words": rf"""
            SELECT doc_id, pos, p, list_transform(
              string_split(regexp_replace(p, '(?i)({_MENTION})', {edge} || '\1', 'g'), {edge}),
              lambda c: regexp_extract_all(c, '{_NS}+')) AS ws
            FROM para WHERE regexp_matches(p, '(?i){_MENTION}')""",
        "windows": f"""
            SELECT doc_id, pos, CASE WHEN regexp_matches(p, '{_LEGEND}') THEN [p] ELSE
              string_split(array_to_string(list_transform(ws, lambda w, i:
                CASE WHEN i = 1 THEN array_to_string(w[greatest(len(w) - {n} + 1, 1):], ' ')
                  WHEN i = len(ws) THEN array_to_string(w[1:{n} + 1], ' ')
                  WHEN len(w) - 1 >= 2 * {n} THEN array_to_string(w[1:{n} + 1], ' ') || chr(10)
                    || array_to_string(w[len(w) - {n} + 1:], ' ')
                  ELSE array_to_string(w, ' ') END), ' '), chr(10)) END AS blurbs
            FROM words""",
    }


_CLOSE = f"""
    SELECT c.doc_id, coalesce(t.text, '') AS text FROM clean c LEFT JOIN
      (SELECT doc_id, string_agg(array_to_string(blurbs, {_BLANK}), {_BLANK} ORDER BY pos) AS text
       FROM windows GROUP BY doc_id) t ON c.doc_id = t.doc_id"""


@query("fig_close_words", _CLOSE, _windows_ctes(50))
def _(x: Inputs):
    return x.view("clean").select("doc_id", figures.figure_text(F.col("text")).alias("text"))


@query("fig_close_words_narrow", _CLOSE, _windows_ctes(3))
def _(x: Inputs):
    return x.view("clean").select(
        "doc_id", figures.figure_text(F.col("text"), "legCloseWords", 3).alias("text")
    )


_BLURBS = """
    SELECT doc_id, CAST(unnest(range(len(bs))) AS INT) AS pos, unnest(bs) AS blurb FROM
      (SELECT doc_id, flatten(list(blurbs ORDER BY pos)) AS bs FROM windows GROUP BY doc_id) b"""


@query("blurb_rows", _BLURBS, _windows_ctes(5))
def _(x: Inputs):
    return pre.blurb_rows(x.view("clean"), "doc_id", "text", n=5)


@query("blurb_blocks", f"""
    SELECT c.doc_id, coalesce(b.blocks, '') || repeat('-', 13) || chr(10) AS blocks FROM clean c LEFT JOIN
      (SELECT doc_id, string_agg(repeat('-', 15) || chr(10) || blurb || chr(10), '' ORDER BY pos) AS blocks
       FROM ({_BLURBS}) x GROUP BY doc_id) b ON c.doc_id = b.doc_id""", _windows_ctes(5))
def _(x: Inputs):
    return x.view("clean").select("doc_id", pre.blurb_blocks(F.col("text"), n=5).alias("blocks"))


@query("blurb_diff", f"""
    SELECT doc_id, blurb, CAST(sum(o) AS BIGINT) AS n_old, CAST(sum(n) AS BIGINT) AS n_new FROM
      (SELECT doc_id, blurb, 1 AS o, 0 AS n FROM ({_BLURBS}) x
       UNION ALL
       SELECT doc_id, p, 0, 1 FROM para WHERE regexp_matches(p, '(?i){_MENTION}')) u
    GROUP BY doc_id, blurb HAVING sum(o) <> sum(n)""", _windows_ctes(5))
def _(x: Inputs):
    corpus = x.view("clean")
    old = pre.blurb_rows(corpus, "doc_id", "text", n=5)
    new = pre.blurb_rows(corpus, "doc_id", "text", "legParagraphs")
    return pre.blurb_diff(old, new, "doc_id")


# -- token rewriting ---------------------------------------------------------

# The checking engine has no look-around, so its alternation is the plain one;
# it agrees on texts without "-/-" and ", cell" directly after another hit.
_RULES = rewrite.mappings(space=_S, non_space=_NS)
_BIG = "(?i)" + "|".join(rf"\b(?:{m.regex})\b" for m in _RULES)
_PICK = "CASE " + " ".join(
    f"WHEN regexp_full_match(h, '(?i)(?:{m.regex})') THEN '{m.replacement}'" for m in _RULES
) + " END"


def _rewrite_sql(c: str) -> str:
    return f"""array_to_string(list_transform(
        list_zip(regexp_split_to_array({c}, '{_BIG}'),
                 list_transform(regexp_extract_all({c}, '{_BIG}'), lambda h: {_PICK})),
        lambda z: z[1] || coalesce(z[2], '')), '')"""


@query("feature_transform", f'SELECT "ID", {_each(_rewrite_sql("{}"))} FROM samples')
def _(x: Inputs):
    return pre.preprocess(x.view("samples"), ["featureTransform"]).select("ID", *_FIELDS)


@query("clean_nostem", f"""
    SELECT "ID", string_agg({_TOKENS.replace("{}", "r")}, '' ORDER BY i) AS text FROM
      (SELECT "ID", i, {_rewrite_sql("piece")} AS r FROM
        (SELECT "ID", unnest(range(len(u))) AS i, unnest(u) AS piece FROM
          (SELECT "ID", regexp_split_to_array({_DOCUMENT}, '{_URL}') AS u FROM samples) a) b) c
    GROUP BY "ID" """)
def _(x: Inputs):
    samples = x.view("samples")
    return samples.select("ID", rewrite.clean_without_stem(pre.document(samples)).alias("text"))


_STEM_CTES = {
    "fields": f"SELECT f.* FROM (" + " UNION ALL ".join(
        f"""SELECT "ID", '{f}' AS field, regexp_split_to_array("{f}", '{_URL}') AS u FROM samples""" for f in _FIELDS) + ") f",
    "pieces": f"""SELECT "ID", field, i, {_rewrite_sql("piece")} AS r FROM
        (SELECT "ID", field, unnest(range(len(u))) AS i, unnest(u) AS piece FROM fields) a""",
    "words": r"""SELECT "ID", field, i, unnest(range(len(t))) AS j, unnest(t) AS word FROM
        (SELECT "ID", field, i, regexp_extract_all(lower(r), '\b[a-z_]\w+\b') AS t FROM pieces) a""",
} | stem_ctes("words") | {
    "stemmed": """SELECT w."ID", w.field, string_agg(' ' || s.stem, '' ORDER BY i, j) AS text
        FROM words w JOIN stems s ON w.word = s.word GROUP BY w."ID", w.field""",
}


@query("clean_stem", "SELECT s.\"ID\", " + ", ".join(
    f"""coalesce((SELECT t.text FROM stemmed t WHERE t."ID" = s."ID" AND t.field = '{f}'), '') AS "{f}\"""" for f in _FIELDS
) + " FROM samples s", _STEM_CTES)
def _(x: Inputs):
    return pre.preprocess(x.view("samples"), ["removeURLsCleanStem"]).select("ID", *_FIELDS)


@query("stem_vocab", """
    SELECT s.word, s.stem, count(*) AS n_texts FROM vocabulary v JOIN stems s ON v.word = s.word GROUP BY s.word, s.stem""",
       {"vocabulary": r"""SELECT unnest(list_distinct(regexp_extract_all(lower(text), '\b[a-z_]\w+\b'))) AS word FROM clean"""}
       | stem_ctes("vocabulary"))
def _(x: Inputs):
    """Distinct words of the corpus with their stem and number of texts."""
    words = F.array_distinct(F.split(F.trim(clean.clean_tokens(F.col("text"))), " "))
    vocabulary = (
        x.view("clean").select(F.explode(words).alias("word")).filter("word <> ''")
        .groupBy("word").agg(F.count("*").alias("n_texts"))
    )
    return vocabulary.select("word", stem.stem_words(F.col("word")).alias("stem"), "n_texts")


def _no_urls(c: str) -> str:
    return f"lower(regexp_replace({c}, '{_URL}', '', 'g'))"


@query("stream_preprocess", f"""
    SELECT s."ID", {_no_urls('s.title')} AS title, {_no_urls('s.abstract')} AS abstract,
      {_no_urls('c.text')} AS "extractedText"
    FROM samples s JOIN ({_CLOSE}) c ON s."ID" = CAST(c.doc_id AS VARCHAR)""", _windows_ctes(50))
def _(x: Inputs):
    """Sample files read as a stream, preprocessed and appended."""
    from litsieve.schema import REF
    from litsieve.sources.samples import write_samples

    inbox = scratch_path(x.spark, "stream-in")
    out = scratch_path(x.spark, "stream-out")
    write_samples(x.view("samples"), inbox, REF)
    job = stream.start(
        stream.stream_samples(x.spark, inbox, REF), ["figureTextLegCloseWords50", "removeURLs"],
        out, scratch_path(x.spark, "stream-state"), once=True,
    )
    job.awaitTermination()
    return x.spark.read.parquet(out)
