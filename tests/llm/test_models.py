"""Segment search, message passing and held-out quality of the trained models."""

from __future__ import annotations

import html
import re
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litsieve.llm import html_extract, labelled_pages, toxicity
from litsieve.llm.common import table
from litsieve.llm.html_tree import parse


def plain_segments(x):
    """Maximal segments by definition: split off the best one, then look left and right of it."""
    def best(a, b):
        top = max(((sum(x[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if top is None or top[0] <= 0:
            return []
        _, _, _, i, j = top
        return [*best(a, i), (i, j, top[0]), *best(j, b)]

    return best(0, len(x))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=14))
def test_segments(x):
    x = [v + i / 1000 for i, v in enumerate(x)]  # no ties: the definition leaves them open
    got = toxicity.segments(np.array(x, float))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in plain_segments(x)]


def test_marginals_by_enumeration():
    tree = parse("<body><nav><a>x</a></nav><article class=post><p>some text<b>y</b></article></body>")
    f = html_extract.forest([tree])
    draw = np.random.default_rng(3)
    model = html_extract.Model(draw.normal(size=len(html_extract._FEATURES)), draw.normal(size=(4, 2, 2)))
    weight = np.bincount(f.node, model.weights[f.feature], f.size)
    total, hit = 0.0, np.zeros(f.size)
    for y in product((0, 1), repeat=f.size):
        y = np.array(y)
        value = (weight * y).sum() + sum(model.edges[f.kind[i], y[f.parent[i]], y[i]] for i in range(1, f.size))
        total += np.exp(value)
        hit += np.exp(value) * y
    assert html_extract.marginals(model, f)[0] == pytest.approx(hit / total)


def test_labelled_pages_held_out():
    model = html_extract.default_model()
    trees = [parse(p) for p in labelled_pages.pages(80, seed=77)]
    f = html_extract.forest(trees)
    y = np.concatenate([html_extract._labels(t) for t in trees])
    text = np.array([x is not None for t in trees for x in t.text])
    assert ((html_extract.marginals(model, f)[0] >= 0.5) == y)[text].mean() > 0.97


def test_pages_of_the_table(spark, folder):
    pages = table(spark, folder, "pages")
    got = {r.page_id: r.text for r in html_extract.extracted(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [html.unescape(re.sub("<[^>]+>", "", p)) for p in re.split(r"<(?:/?p|/?h1|br)>", inner)]
        assert got[r.page_id] == " ".join(" ".join(p.split()) for p in parts if p.split())


def test_page_parts():
    page = (
        "<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body><header><a href=/>Site</a></header>"
        '<div class="cookie-notice"><p>We use cookies on this site.</p></div><nav><ul><li><a href=/a>Home</a></ul></nav>'
        "<article><h1>A title</h1><p>First &amp; <b>bold</b>er text&nbsp;here, long enough to be read.<p>Second one, "
        'also of some length.<br>New line<ul><li>item</li></ul><div class="ad">Buy now</div></article>'
        '<div id="comments"><h3>Comments</h3><div class=comment><p>I disagree with all of this.</p></div></div>'
        "<form><label>Mail</label><button>Go</button></form><!-- x --><footer>&copy; Site</footer></body></html>"
    )
    text = "A title First & bolder text here, long enough to be read. Second one, also of some length. New line item"
    assert list(html_extract._texts([page], html_extract.default_model())) == [text]


def test_toxicity_held_out(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    rows = toxicity.scored(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    y = np.array([r.toxic for r in rows])
    p = np.array([r.predicted for r in rows])
    assert p[y == 1].mean() > 0.88 and p[y == 0].mean() < 0.02
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    same = toxicity.scored(docs, turned).select("doc_id", "score")
    before = {r.doc_id: r.score for r in rows}
    assert all(before.get(r.doc_id, r.score) == pytest.approx(r.score, abs=1e-12) for r in same.collect())


def test_only_near_copies_count_once():
    draw = np.random.default_rng(5)
    common = [f"c{i}" for i in range(40)]  # every text has these words
    base = [common + [f"w{k}" for k in draw.integers(0, 5000, 60)] for _ in range(200)]
    copies = [[*w[:-2], "x", "y"] for w in base[:50]]
    memo = toxicity._Forms()
    signs = np.array([toxicity._minima(" ".join(w), memo) for w in base + copies + base[:5]])
    kept = toxicity.distinct(signs)
    # copies of the first 50 texts fall to them or they to their copies; no other text is lost
    assert len(kept) == 200 and {k if k < 200 else (k - 200) % 50 for k in kept} == set(range(200))


def test_each_passage_is_judged_on_its_own():
    bad = "vile rude foul mean".split()
    line = toxicity.Model({toxicity.forms(w)[0]: 3.0 for w in bad}).line()
    found = lambda t: toxicity.passages(t, line)[0]
    plain = ["word"] * 100
    assert found(bad + plain + bad) == [(0, 4, 10.0), (104, 108, 10.0)]
    single = [x for w in bad for x in [w, *plain]]
    assert found(single + bad)[-1] == (404, 408, 10.0)
    # said over and over in one passage, a word counts once
    assert found(["vile"] * 50) == [(0, 50, 2.5)]
    assert found([*bad, "word", *bad]) == [(0, 9, 10.0)]
