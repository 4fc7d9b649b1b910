"""English stemming after the published Porter2 (Snowball English) rules.

Spark has no stemmer, so this is the one place that leaves the JVM: an Arrow
UDF over whole cleaned texts. It works row by row without a shuffle, and each
worker remembers the stems it has met, so a word costs one dictionary lookup.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

_VOWEL = "[aeiouy]"
_OTHER = "[^aeiouy]"

# Fixed values of the published algorithm.
_WHOLE_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli",
    "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
_KEPT_AFTER_PLURAL = {
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed",
}
_REGION_PREFIX = re.compile("gener|commun|arsen")
_DERIVATION = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
_REDUCTION = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
_REMOVAL = dict.fromkeys(
    ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
     "ism", "ate", "iti", "ous", "ive", "ize", "ion"),
    "",
)


def _longest(table):
    """Regex for the longest suffix of the table that ends a word."""
    return re.compile("(?:" + "|".join(sorted(table, key=len, reverse=True)) + ")$")


_DERIVATION_RE = _longest(_DERIVATION)
_REDUCTION_RE = _longest(_REDUCTION)
_REMOVAL_RE = _longest(_REMOVAL)
_REGION_RE = re.compile(f"{_VOWEL}{_OTHER}")
# a vowel between consonants (the last not w, x or Y), or a word of vowel + consonant
_SHORT_SYLLABLE_RE = re.compile(f"(?:{_OTHER}{_VOWEL}[^aeiouywxY]|^{_VOWEL}{_OTHER})$")
_PAST_RE = re.compile("(?:edly|ed|ingly|ing)$")
_DOUBLE_RE = re.compile("(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$")


def _region(word: str, start: int) -> int:
    """Where the part after the first vowel-consonant pair begins."""
    hit = _REGION_RE.search(word, start)
    return hit.end() if hit else len(word)


def _ends_short(word: str) -> bool:
    return _SHORT_SYLLABLE_RE.search(word) is not None


@lru_cache(maxsize=1 << 18)
def stem(word: str) -> str:
    word = word.lower()
    if len(word) <= 2:
        return word
    if word in _WHOLE_WORDS:
        return _WHOLE_WORDS[word]
    word = word.removeprefix("'")
    # a y that opens a syllable acts as a consonant and is written Y meanwhile
    word = re.sub(f"^y|({_VOWEL})y", r"\1Y", word)

    prefix = _REGION_PREFIX.match(word)
    r1 = prefix.end() if prefix else _region(word, 0)
    r2 = _region(word, r1)

    word = re.sub("(?:'s'|'s|')$", "", word)

    # plurals
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith(("ied", "ies")):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("s") and not word.endswith(("us", "ss")):
        if re.search(_VOWEL, word[:-2]):
            word = word[:-1]
    if word in _KEPT_AFTER_PLURAL:
        return word

    # past tense and gerund
    eed = re.search("eed(?:ly)?$", word)
    past = _PAST_RE.search(word)
    if eed:
        if eed.start() >= r1:
            word = word[: eed.start()] + "ee"
    elif past and re.search(_VOWEL, word[: past.start()]):
        word = word[: past.start()]
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif _DOUBLE_RE.search(word):
            word = word[:-1]
        elif r1 >= len(word) and _ends_short(word):
            word += "e"

    word = re.sub(f"(?<=.{_OTHER})[yY]$", "i", word)

    # derivational suffixes
    hit = _DERIVATION_RE.search(word)
    if hit and hit.start() >= r1:
        suffix, before = hit.group(), word[: hit.start()]
        fits = {"ogi": before.endswith("l"), "li": before[-1:] in tuple("cdeghkmnrt")}
        if fits.get(suffix, True):
            word = before + _DERIVATION[suffix]

    hit = _REDUCTION_RE.search(word)
    if hit and hit.start() >= (r2 if hit.group() == "ative" else r1):
        word = word[: hit.start()] + _REDUCTION[hit.group()]

    hit = _REMOVAL_RE.search(word)
    if hit and hit.start() >= r2:
        if hit.group() != "ion" or word[: hit.start()].endswith(("s", "t")):
            word = word[: hit.start()]

    # final e and l
    last = len(word) - 1
    if word.endswith("e"):
        if last >= r2 or (last >= r1 and not _ends_short(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and last >= r2:
        word = word[:-1]
    return word.lower()


@F.pandas_udf(T.StringType())
def _stem_words(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: " ".join(map(stem, t.split(" "))), na_action="ignore")


def stem_words(c: Column) -> Column:
    """Stem every blank-separated word, keeping the blanks as they are."""
    return _stem_words(c)
