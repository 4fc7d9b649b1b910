"""Token rewriting: worked cases, and random texts against a plain model."""

from __future__ import annotations

import random
import re

import pytest

from litsieve.functions import rewrite

CASES = {
    "at e12, E 1 and E9": "at embryonic_day, embryonic_day and embryonic_day",
    "from E day 1 to embryonic day 7 on": "from embryonic_day to embryonic_day on",
    # three digits are no day, and "day" starts like a cell line
    "until embryonic day 117 at most": "until embryonic cell_line 117 at most",
    "our -/- e12. line": "our mut_mut embryonic_day. line",
    "two tumours, one tumor": "two tumor_type, one tumor_type",
    "see fig s1 (fig a23) g6 too": "see figure  (figure a23)  too",
    "wildtypes, wild type; wt Wt wild\ntype wild-types":
        "wild_type, wild_type; wild_type wild_type wild_type wild_type",
    "knockout knocksouts knocked out: ko Ko knock\nout knock-outs":
        "knock_out knock_out knock_out: knock_out knock_out knock_out knock_out",
    "knockin, knocked-in, knock ins": "knock_in, knock_in, knock_in",
    "1 cell, 2-cell, one-cell, blastocyst": "early_embryo, early_embryo, early_embryo, early_embryo",
    "genetrap, gene traps, gene-trapped": "gene_trap, gene_trap, gene_trap",
    "B16, b-16x. SP2/0 but f9 or F19": "cell_line, cell_line. cell_line but  or F19",
    "adenoma myadenoma carcinoma neoplasms": "tumor_type tumor_type tumor_type tumor_type",
    "sarcoma 180 R1.1 RxL1": "tumor_type 180 cell_line RxL1",
    # a hit ends the text as far as word boundaries go
    "ko-/- mice": "knock_out-/- mice",
    "": "",
}


def test_cases(one):
    assert one(list(CASES), rewrite.rewrite) == list(CASES.values())


def test_dictionaries(one):
    texts = ["R1x1 R1.1"]
    assert one(texts, rewrite.rewrite) == ["cell_line cell_line"]
    escaped = rewrite.mappings("escaped")
    assert one(texts, lambda c: rewrite.rewrite(c, escaped)) == ["R1x1 cell_line"]
    with pytest.raises(ValueError):
        rewrite.mappings("other")
    with pytest.raises(ValueError):
        rewrite.rewrite(None, [rewrite.Mapping("x", "(a)", "b")])


# -- model: search, replace, go on with the remaining text as a new text ------


def _plain_patterns():
    """The alternatives as Python regexes, cell lines as plain lists."""
    s = r"[\s]"
    rules = {m.name: m for m in rewrite.mappings(space=s, non_space=r"\S")}
    regexes = {n: m.regex for n, m in rules.items()}
    regexes["cl"] = "|".join(p + r"\S*" for p in rewrite.CELL_LINE_PREFIXES)
    regexes["cn"] = "|".join(rewrite.CELL_LINE_NAMES)
    big = "|".join(rf"\b({r})\b" for r in regexes.values())
    return re.compile(big, re.I), [rules[n].replacement for n in regexes]


PATTERN, REPLACEMENTS = _plain_patterns()


def model(text: str) -> str:
    done = []
    while hit := PATTERN.search(text):
        done += [text[: hit.start()], REPLACEMENTS[hit.lastindex - 1]]
        text = text[hit.end():]
    return "".join(done) + text


def _texts(n: int, extra=()) -> list[str]:
    rnd = random.Random(5)
    pool = ["mouse", "ko", "knock", "out", "-/-", "wild", "type", "wt", "fig", "a1", "s2", "E3", "e",
            "12", "1", "2,", "cell", "one", "day", "embryonic", "tumour", "adenomas", "melanoma",
            "gene", "traps", "HeLa", "R1.1", "MCA", "sp2/0", "B-16x", "C1300-NB", "lewis lung",
            "sarcoma 180", "x", "_", ".", ",", "-", "(", "\n", "word", "blastocysts", *extra]
    pool += rnd.sample(rewrite.CELL_LINE_NAMES, 40)
    return ["".join(rnd.choice(pool) + rnd.choice(["", " ", " ", "-", ",", "/"])
                    for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def test_random_texts(one):
    texts = _texts(6000)
    expected = [model(t) for t in texts]
    assert sum(a != b for a, b in zip(texts, expected)) > 5000
    assert one(texts, rewrite.rewrite) == expected


def test_texts_with_framing_characters(one):
    texts = _texts(600, ("\uFDD0", "\uFDD1"))
    assert one(texts, rewrite.rewrite) == [model(t) for t in texts]


def test_published_document(one):
    # A published example and its result.
    text = (
        "My text: it's a knock out https://foo text www.foo.org word word  -/-.\n\n"
        "This could be a table reference paragraph.\n\nFigure. 1: this is a figure legend\n\n"
        "the final words"
    )
    texts = ["My Title w/ Fig text", "\nMy Abstract w/ Fig text and -/-", text]
    assert one(texts, rewrite.clean_and_stem) == [
        " my titl figur text",
        " my abstract figur text and",
        " my text it knock_out text word word mut_mut this could be tabl refer paragraph figur this "
        "is figur legend the final word",
    ]


def test_very_long_runs(one):
    """Texts without a break neither overflow the matcher nor take forever."""
    from litsieve.functions import clean, figures

    n = 300_000
    runs = ["da" + "x" * n, "é" * n, "-/" * n, "a" * n + "lymphoma", "knock" + " " * n + "out", "a1 " * n,
            "fig " * n, "http://" + "y" * n]
    got = one(runs, rewrite.rewrite)
    assert got[0] == "cell_line" and got[3] == "tumor_type" and got[5] == " " * n
    assert len(one(runs, clean.remove_urls)[7]) == 0
    assert one(runs, lambda c: figures.figure_text(c, n=2))[6] == ("fig " * n).strip()
    assert one(runs, rewrite.clean_without_stem)[0] == " cell_line"
    assert [len(p) for p in one(runs, figures.paragraphs)] == [1] * len(runs)
