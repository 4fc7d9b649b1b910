"""Disguised identifiers and near misses, with the source characters they cover."""

from __future__ import annotations

import time

import pytest

from litsieve.llm import pii, secret_scan

FOUND = {
    "write jane  (at)  example  (dot)  com now": [("email", "jane  (at)  example  (dot)  com")],
    "write jane\t[at]\texample\t[dot]\tcom now": [("email", "jane\t[at]\texample\t[dot]\tcom")],
    "write jane at mail.example dot com now": [("email", "jane at mail.example dot com")],
    "write jane&#64;example&#46;com now": [("email", "jane&#64;example&#46;com")],
    "write jane&commat;example&period;com or joe&#x40;a.org": [
        ("email", "jane&commat;example&period;com"), ("email", "joe&#x40;a.org")],
    "call plus four four two zero seven nine four six zero nine five eight": [
        ("phone", "plus four four two zero seven nine four six zero nine five eight")],
    "host one nine two dot one six eight dot zero dot one is up": [
        ("ip", "one nine two dot one six eight dot zero dot one")],
    "old form jane [at] example [dot] com": [("email", "jane [at] example [dot] com")],
}
CLEAN = [
    "", "meet me at noon dot", "we arrived at example.com in time", "look at it . then go", "plus one or two",
    "five plus four four two", "one two three dot four", "a &amp; b &#65; c", "nine nine nine dot nine nine nine dot one dot two",
    "he stood at the dot of noon", "surplus four four two zero seven nine four six",
]


@pytest.mark.parametrize("text", FOUND)
def test_found(text):
    base, every = pii.find(text)
    got = [(kind, text[a:b]) for a, b, kind in every if (a, b, kind) not in base]
    assert got == FOUND[text]


@pytest.mark.parametrize("text", CLEAN)
def test_clean(text):
    assert pii.find(text) == ([], [])


def test_spans_after_a_disguise_are_in_place():
    text = "a&#64;b.org then c(at)d(dot)org and +1 555 010 9999 at last"
    assert [text[a:b] for a, b, _ in pii.find(text)[1]] == ["a&#64;b.org", "c(at)d(dot)org", "+1 555 010 9999"]


def test_long_texts_stay_linear():
    for piece in ("a at ", "one two dot ", "&#64;", "plus four ", "x.y.z at ", "( dot ) "):
        began = time.perf_counter()
        pii.find(piece * 40_000)
        assert time.perf_counter() - began < 20


def test_offsets_of_many_matches(spark):
    """Two levels of running sums, at the ends of pieces and far beyond."""
    from pyspark.sql import functions as F

    for n in (0, 1, 127, 128, 129, 1000, 200_000):
        words = [f"é{'w' * (k % 5)} abcdefghij{k:06d}" for k in range(n)]
        df = spark.createDataFrame([(" ".join(words),)], "text string")
        rows = secret_scan._runs(df, "found", secret_scan.CANDIDATE, F.lit(True)).select("text", "found").first()
        assert [rows.text[s:e] for s, e, _ in rows.found] == [h for _, _, h in rows.found]
        assert len(rows.found) == n
