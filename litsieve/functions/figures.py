"""Figure and table passages of an article, as column expressions.

A *paragraph* lies between blank lines. A *legend* is a paragraph that starts
like a figure or table caption; a *mention* is a figure or table word anywhere.
Everything is evaluated per row, so it needs no shuffle and runs on a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from litsieve.functions.clean import ANY_SPACE, NON_SPACE_RUN, strip

# Figure words (plurals allowed) and caption starts (no plurals).
MENTION = r"\b(?:fig(?:ure)?|table)s?\b"
CAPTION = (
    rf"\b(?:(?:(?:supp\w*|online|extended{ANY_SPACE}data){ANY_SPACE})?"
    r"fig(?:ure)?|table)\b"
)
PARAGRAPH_BREAK = "\n\n"

_HAS_MENTION = f"(?i){MENTION}"
_IS_LEGEND = f"(?i)^{CAPTION}"
_BEFORE_MENTION = f"(?i)(?={MENTION})"


def paragraphs(text: Column) -> Column:
    """Stripped paragraphs, empty ones included."""
    return F.transform(F.split(text, PARAGRAPH_BREAK), strip)


def _is_legend(p: Column) -> Column:
    return p.rlike(_IS_LEGEND)


def _mentions(p: Column) -> Column:
    return p.rlike(_HAS_MENTION)


def legends(text: Column) -> Column:
    return F.filter(paragraphs(text), _is_legend)


def legends_and_paragraphs(text: Column) -> Column:
    return F.filter(paragraphs(text), _mentions)


def _windows(p: Column, n: int) -> Column:
    """Word windows around the mentions of one paragraph, one per line.

    The paragraph is cut before every mention, so each piece after the first
    opens with one. A piece whose words after the mention fill both windows
    (2n or more) keeps n words at either end and a line break between them;
    any shorter piece is kept whole and so joins its neighbours' windows. Words
    hold no whitespace, so a line break can only be such a gap. The added blank
    makes the first piece exist even if the paragraph opens with a mention.
    """
    cut = F.split(F.concat(F.lit(" "), p), _BEFORE_MENTION)
    pieces = F.transform(
        cut, lambda piece: F.regexp_extract_all(piece, F.lit(NON_SPACE_RUN), F.lit(0))
    )

    def join(w: Column) -> Column:
        return F.array_join(w, " ")

    def tail(w: Column) -> Column:
        return join(F.slice(w, F.greatest(F.size(w) - (n - 1), F.lit(1)), F.lit(n)))

    def first(w: Column) -> Column:
        return join(F.slice(w, 1, n + 1))

    def middle(w: Column) -> Column:
        return F.when(F.size(w) > 2 * n, F.concat(first(w), F.lit("\n"), tail(w))).otherwise(
            join(w)
        )

    # first and last piece are cut on one side only
    def passages(words: Column) -> Column:
        inner = F.transform(F.slice(words, F.lit(2), F.size(words) - 2), middle)
        last = F.transform(F.slice(words, -1, 1), first)
        return F.concat(tail(words[0]), F.lit(" "), F.array_join(F.concat(inner, last), " "))

    # bound through an array of one, so that the words are found only once
    return F.transform(F.array(pieces), passages)[0]


def close_words(text: Column, n: int = 50) -> Column:
    """Whole legends, and for other paragraphs n words around each mention."""
    if n < 1:
        raise ValueError("number of words must be at least 1")
    return F.flatten(
        F.transform(
            legends_and_paragraphs(text),
            lambda p: F.when(_is_legend(p), F.array(p)).otherwise(
                F.split(_windows(p, n), "\n")
            ),
        )
    )


CONVERTERS: dict[str, Callable[..., Column]] = {
    "legends": lambda text, n: legends(text),
    "legParagraphs": lambda text, n: legends_and_paragraphs(text),
    "legCloseWords": close_words,
}


def converter(kind: str, n: int = 50) -> Callable[[Column], Column]:
    """Text column -> array of passages, by flavour name."""
    if kind not in CONVERTERS:
        raise ValueError(f"invalid figure text conversion {kind!r}")
    return lambda text: CONVERTERS[kind](text, n)


def figure_text(text: Column, kind: str = "legCloseWords", n: int = 50) -> Column:
    """All passages as one text, a blank line between them."""
    return F.array_join(converter(kind, n)(text), PARAGRAPH_BREAK)
