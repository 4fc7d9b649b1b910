"""Pages of kinds that the training pages are not made of by rule, written by hand."""

from __future__ import annotations

import pytest

from litsieve.llm import html_extract


def _words(n, k=0):
    return " ".join(f"w{(i * 7 + k) % 90}" for i in range(n))


LONG, MORE = _words(60), _words(40, 3)
MENU = "<nav><ul><li><a href=x>home</a><li><a href=x>about</a></ul></nav>"
WHOLE = {
    "paragraphs in the body": "<body>" + "".join(f"<p>{_words(20, i)}</p>" for i in range(4)) + "</body>",
    "old layout": f"<body><center><font>{LONG}</font></center></body>",
    "foreign class": f"<body>{MENU}<div class='prose'><p>{LONG}</p><p>{MORE}</p></div></body>",
    "misleading id": f"<body><div id='right'><p>{LONG}</p></div></body>",
    "bare lines": f"<body>{LONG}<br>{MORE}<br>{LONG}</body>",
    "no markup": LONG,
    "layout table": f"<body><table><tr><td><a href=1>one</a><br><a href=2>two</a><br><a href=3>three</a></td><td><p>{LONG}</p></td></tr></table></body>",
}


def _main(page):
    return next(html_extract._texts(iter([page]), html_extract.default_model()))


@pytest.mark.parametrize("kind", WHOLE)
def test_article_is_kept(kind):
    text = _main(WHOLE[kind])
    n = {"paragraphs in the body": 80, "foreign class": 100, "bare lines": 160}.get(kind, 60)
    assert len(text.split()) == n and "home" not in text and "three" not in text


def test_what_browsers_hide_is_left_out():
    page = (f"<article><p>{LONG}</p><p hidden>secret</p><div style='color:red; display: none'><p>secret</p></div>"
            f"<p data-hidden=1>{MORE}</p></article>")
    assert _main(page) == f"{LONG} {MORE}"


def test_pages_without_an_article():
    assert _main(f"<body>{MENU}<footer><p>copyright x</p></footer></body>") == ""
    assert _main("") == "" and _main("<p>") == ""


def test_columns_of_the_page_table_may_clash(spark):
    from pyspark.sql import functions as F

    rows = [(1, "u", f"<p>{LONG}</p><p>{LONG}</p>"), (1, "u", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.withColumn("text", F.lit("own")).withColumn("n_chars", F.lit("own"))
    got = html_extract.extracted(df).collect()
    assert sorted((r.page_id, r.url, r.n_chars) for r in got) == [(1, "u", 0), (1, "u", 2 * len(LONG) + 1)]


def test_a_page_of_megabytes():
    page = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    assert len(_main(page)) == 20_000 * (len(LONG) + 1) - 1
