"""Row-local cleaning of article text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from litsieve.schema import FIELD_SEP, RECORD_END

# What Python's str.split / str.strip and ``\s`` treat as whitespace; Java's
# ``\s`` is narrower.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_SPACE_RANGES = (
    r"\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
)
ANY_SPACE = f"[{_SPACE_RANGES}]"
NON_SPACE = f"[^{_SPACE_RANGES}]"
# A run of non-space characters; the common ASCII part has its own quick class.
NON_SPACE_RUN = rf"(?:[\x21-\x7E]++|{NON_SPACE})++"

# What counts as a URL, and as a token worth keeping.
URL = rf"(?i)\b(?:https?://|www[.]|doi)(?:{NON_SPACE_RUN})?"
# 'doi' only when it introduces an identifier, so that "doing" survives
URL_STRICT_DOI = rf"(?i)\b(?:https?://|www[.]|doi(?=[:./\s]))(?:{NON_SPACE_RUN})?"
TOKEN = r"\b[a-z_]\w+\b"
WORD = r"\w+"


def as_text(c: Column, null_as: str = "") -> Column:
    return F.coalesce(c.cast("string"), F.lit(null_as))


def scrub_delimiters(c: Column) -> Column:
    """Blank out record ends, then field separators."""
    return F.replace(
        F.replace(c, F.lit(RECORD_END), F.lit(" ")), F.lit(FIELD_SEP), F.lit(" ")
    )


def scrub_non_ascii(c: Column) -> Column:
    """One blank per non-ASCII character."""
    return F.regexp_replace(c, r"[^\x00-\x7F]", " ")


def clean_text(c: Column, max_length: int = 0, null_as: str = "") -> Column:
    """Text as it enters a sample; ``max_length`` is the debugging cut."""
    text = as_text(c, null_as)
    if max_length:
        text = F.replace(F.substring(text, 1, max_length), F.lit("\n"), F.lit(" "))
    return scrub_non_ascii(scrub_delimiters(text))


def ingest_text(c: Column, max_length: int = 0, null_as: str = "") -> Column:
    """As :func:`clean_text`, for the main text: a cut text ends in a newline."""
    text = clean_text(c, max_length, null_as)
    return F.concat(text, F.lit("\n")) if max_length else text


def underscore_spaces(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit("_"))


def normalise_journal(c: Column) -> Column:
    """Strip, lower-case, blanks to underscores."""
    return underscore_spaces(F.lower(strip(c)))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def make_document(title: Column, abstract: Column, text: Column) -> Column:
    return F.concat_ws("\n", *(as_text(c) for c in (title, abstract, text)))


def head(c: Column, n: int) -> Column:
    """First n characters on one line."""
    return F.replace(F.substring(c, 1, n), F.lit("\n"), F.lit(" "))


def remove_urls(c: Column, strict_doi: bool = False) -> Column:
    return F.lower(F.regexp_replace(c, URL_STRICT_DOI if strict_doi else URL, ""))


def token_per_line(c: Column) -> Column:
    return F.array_join(
        F.transform(
            F.regexp_extract_all(c, F.lit(WORD), F.lit(0)),
            lambda t: F.concat(t, F.lit("\n")),
        ),
        "",
    )


def clean_tokens(c: Column) -> Column:
    """Lower-cased tokens of two or more characters, each behind one blank."""
    return F.array_join(
        F.transform(
            F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0)),
            lambda t: F.concat(F.lit(" "), t),
        ),
        "",
    )


def journal_feature(document: Column, journal: Column) -> Column:
    """Append the journal to a document as one feature token."""
    return F.concat(
        as_text(document), F.lit(" journal__"), normalise_journal(as_text(journal))
    )
