"""Stems of the published algorithm's examples and of known feature names."""

import random

import duckdb
import pandas as pd

from litsieve.functions import stem as rules
from litsieve.functions.stem import stem, stem_words
from litsieve.plans.catalog.stemming import stem_ctes

STEMS = {
    "abbreviation": "abbrevi", "aberrant": "aberr", "ability": "abil", "ablation": "ablat",
    "compared": "compar", "deficient": "defici", "deletion": "delet", "figure": "figur",
    "genotype": "genotyp", "littermates": "litterm", "significantly": "signific", "table": "tabl",
    "cell_line": "cell_lin", "wild_type": "wild_typ", "knock_out": "knock_out", "mice": "mice",
    "transgenic": "transgen", "evaluate": "evalu", "values": "valu", "treatment": "treatment",
    "concentrations": "concentr", "respectively": "respect", "investigation": "investig",
    "mechanisms": "mechan", "zebrafish": "zebrafish", "younger": "younger", "patients": "patient",
    "clinical": "clinic", "potential": "potenti", "following": "follow", "based": "base",
    # worked examples of the published rules
    "consigned": "consign", "consistency": "consist", "consolatory": "consolatori", "knackeries": "knackeri",
    "knightly": "knight", "knives": "knive", "generously": "generous", "communism": "communism",
    "hopping": "hop", "hoping": "hope", "agreed": "agre", "luxuriating": "luxuri", "cries": "cri",
    "ties": "tie", "gas": "gas", "this": "this", "gaps": "gap", "kiwis": "kiwi", "cry": "cri",
    "by": "by", "say": "say", "dying": "die", "skies": "sky", "inning": "inning", "herrings": "herring",
    "proceeding": "proceed", "bled": "bled", "bed": "bed", "falling": "fall", "relational": "relat",
}


def test_known_stems():
    assert {w: stem(w) for w in STEMS} == STEMS


def test_over_texts(one):
    assert one([" my titles", "", None], stem_words) == [" my titl", "", None]


def test_sql_has_the_same_stems():
    """Known words, and beginnings, vowels, doubles and endings put together at random."""
    rnd = random.Random(8)
    starts = ["", "y", "gener", "commun", "arsen", "un", "st", "be", "cry", "sa", "oo", "qu", "e1_", "_a", "xyz", "hop", "fall", "lov"]
    ends = [*rules._DERIVATION, *rules._REDUCTION, *rules._REMOVAL, "s", "es", "ies", "ied", "sses", "us", "ss", "ed", "edly",
            "ing", "ingly", "eed", "eedly", "at", "bl", "iz", "tt", "y", "e", "ll", "ogi", "logi", "ative", ""]
    words = [*STEMS, *rules._WHOLE_WORDS, *rules._KEPT_AFTER_PLURAL, "a", "by", "eed", "ied", "ies", "sses", "ing"]
    for _ in range(20_000):
        middle = "".join(rnd.choices("aeiouybcdlmnrstwxz", k=rnd.randrange(4)))
        words.append(rnd.choice(starts) + middle + "".join(rnd.choices(ends, k=rnd.randint(1, 3))))
    words = sorted({w for w in words if w})
    con = duckdb.connect()
    con.register("given", pd.DataFrame({"word": words}))
    ctes = ", ".join(f"{n} AS ({q})" for n, q in stem_ctes("given").items())
    got = dict(con.execute(f"WITH {ctes} SELECT word, stem FROM stems").fetchall())
    assert {w: (got[w], stem(w)) for w in words if got[w] != stem(w)} == {}
