"""Figure passages: worked cases, and random texts against a plain model."""

from __future__ import annotations

import random
import re

import pytest

from litsieve.functions import figures

ARTICLE = """
opening words. Fig 1 shows the result, as expected.

Nothing to see in this paragraph, it is suitable reading.

Figure 1: the first caption
goes on here.

Nothing here either, nor in a
gofigure

Figures help a reader but open no caption.

A word about tables. And more.

Table: a caption of a table

Supplemental Figure 3: a caption with a lead word

Supp Figure 4:
another one

Extended Data Figure: one more

Online Figure 5: the last caption

see the supp figure there

The end of it"""


def test_paragraphs(one):
    got = one(["", "abc def", "\n\nabc def\n\n", "abc\n\n def ghi \n\nend"], figures.paragraphs)
    assert got == [[""], ["abc def"], ["", "abc def", ""], ["abc", "def ghi", "end"]]


def test_legends(one):
    (got,) = one([ARTICLE], figures.legends)
    assert [g.split(":")[0] for g in got] == [
        "Figure 1", "Table", "Supplemental Figure 3", "Supp Figure 4", "Extended Data Figure",
        "Online Figure 5",
    ]


def test_legends_and_paragraphs(one):
    (got,) = one([ARTICLE], figures.legends_and_paragraphs)
    assert len(got) == 10
    assert not any("suitable" in g or "gofigure" in g for g in got)


def test_close_words(one):
    (got,) = one([ARTICLE], lambda c: figures.close_words(c, 2))
    assert got[0] == "opening words. Fig 1 shows"
    assert got[2] == " Figures help a"
    assert got[3] == "word about tables. And more."
    assert got[-1] == "the supp figure there"


def test_edges(one):
    texts = ["", "\n\n", "a figure\n\n", "s\n\n figure 1 blah\n\nD\n\n a fig sentence\n\nE"]
    assert one(texts, figures.legends_and_paragraphs) == [
        [], [], ["a figure"], ["figure 1 blah", "a fig sentence"]
    ]


def test_sample_with_fifty_words(one):
    text = (
        "My text: it's a knock out https://foo text www.foo.org word word  -/-.\n\n"
        "This could be a table reference paragraph.\n\nFigure. 1: this is a figure legend\n\n"
        "the final words"
    )
    assert one([text], figures.figure_text) == [
        "This could be a table reference paragraph.\n\nFigure. 1: this is a figure legend"
    ]


def test_unknown_kind_and_size():
    with pytest.raises(ValueError):
        figures.converter("words")
    with pytest.raises(ValueError):
        figures.close_words(None, 0)


# -- model: islands of word positions around the mentions ---------------------

MENTION = re.compile(r"\b(?:fig(?:ure)?|table)s?\b", re.I)
LEGEND = re.compile(r"\b(?:(?:(?:supp\w*|online|extended\sdata)\s)?fig(?:ure)?|table)\b", re.I)


def islands(p: str, n: int) -> list[str]:
    """Merge the windows of mentions that are less than 2n words apart."""
    words, anchors, last = [], [], 0
    for m in MENTION.finditer(p):
        words += p[last:m.start()].split()
        anchors.append(len(words))
        last = m.start()
    words += p[last:].split()
    groups = []
    for a in anchors:
        if groups and a - groups[-1][-1] - 1 < 2 * n:
            groups[-1].append(a)
        else:
            groups.append([a])
    return [
        (" " if g[0] == 0 else "") + " ".join(words[max(0, g[0] - n): g[-1] + n + 1])
        for g in groups
    ]


def model(text: str, n: int) -> list[str]:
    out = []
    for p in (q.strip() for q in text.split("\n\n")):
        out += [p] if LEGEND.match(p) else islands(p, n)
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 50])
def test_random_texts(one, n):
    rnd = random.Random(n)
    pool = ["w", "word", "fig", "Figures", "(Fig", "table.", "Tables", "suitable", "fig-2",
            "supp", "figure", "online", "x1", "\n", "\n\n", "\t", "\x1c", "-", "fig/table"]
    texts = ["".join(rnd.choice(pool) + rnd.choice([" ", " ", "\n", "", "  "])
                     for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    assert one(texts, lambda c: figures.close_words(c, n)) == [model(t, n) for t in texts]
