"""Personal data with offset-preserving deobfuscation.

Base identifiers are found in the text as it stands. Then transducers rewrite disguises -
look-alike letters to ASCII, spelled digits to digits, "at" and "dot" in brackets or in
words to the signs - and note for every output character which source characters it came
from. Identifiers found in the rewritten text are mapped back to source spans, and those
that reach beyond every base span of their kind are added.

"at" before a domain with plain dots stays as it is, since most of such places are no address.
All scans are linear in the length of a text. Null texts count as empty; repeated rows are
each returned; an empty table gives no rows; other columns are kept by the mask and ignored
by the scan, whatever their names. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litsieve.llm import common

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits that fails from its start fails from within as well
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every @ back over its local part, so that long runs are walked once."""
    done, at = 0, text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at)
        if found:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = found.end()
                yield start, done
                at = text.find("@", done)
                continue
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0") or "0"
    return len(part) < 4 and int(part) < 256


def identifiers(text: str) -> list[Span]:
    """(start, end, kind) of all identifiers in the text as it stands."""
    spans = [(s, e, "email") for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            spans += [
                (m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(map(_octet, m.groups()))
            ]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                    spans.append((m.start(), m.end(), "phone"))
    return ordered(spans)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# --- transducers

# Look-alikes of ASCII letters and signs, in pairs.
_LOOK_ALIKES = (
    "аaеeоoрpсcуyхxіiјjѕsԁdһhкkмmтtвbнnАAВBЕEКKМMНHОOРPСCТTХXІIЅSЈJ"
    "αaοoνvρpιiκkΑAΒBΕEΖZΗHΙIΚKΜMΝNΟOΡPΤTΥYΧX＠@．.。.․.－-‐-‑-‒-–-＋+﹢+﹫@"
)
_FOLD = dict(zip(_LOOK_ALIKES[::2], _LOOK_ALIKES[1::2]))
_FOLD |= {chr(0xFF01 + k): chr(0x21 + k) for k in range(94)}  # full-width forms
_FOLD |= {chr(0x0660 + k): str(k) for k in range(10)}
_FOLD |= {chr(0x06F0 + k): str(k) for k in range(10)}
_FOLD |= {chr(0x1D7CE + k): str(k % 10) for k in range(50)}  # styled digits
_HIDDEN = "​‌‍⁠﻿­"  # characters of no width
_STRANGE = re.compile("[" + "".join(map(re.escape, [*_FOLD, *_HIDDEN])) + "]")
_TABLE = str.maketrans(_FOLD)

_SPELLED = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())}
_SPELLED["oh"] = "0"
_NUMERAL = f"(?:{'|'.join(_SPELLED)}|[0-9])"
_SPELLING = re.compile(rf"(?i)(?<![A-Za-z0-9]){_NUMERAL}(?:[\x20.-]{{1,3}}{_NUMERAL}){{4,}}(?![A-Za-z0-9])")
_SPOKEN = re.compile(rf"(?i){_NUMERAL}")

_GAP = "[\\x20\\t\\xA0]"  # blanks within a line
_DOT_SIGN = rf"(?:{_GAP}{{0,3}}[\[({{<]{_GAP}{{0,3}}(?:dot|\.){_GAP}{{0,3}}[\])}}>]{_GAP}{{0,3}}|{_GAP}{{1,3}}dot{_GAP}{{1,3}})"
#: A bare "at" is a sign only before a domain whose last dot is spelled; no domain is an article.
_AT = re.compile(
    rf"(?i)(?<=[A-Za-z0-9_])(?:{_GAP}{{0,3}}[\[({{<]{_GAP}{{0,3}}(?:at|@){_GAP}{{0,3}}[\])}}>]{_GAP}{{0,3}}"
    rf"|{_GAP}{{1,3}}@{_GAP}{{1,3}}|{_GAP}{{1,3}}at{_GAP}{{1,3}}(?!(?:the|an?|this|that|each|every){_GAP})(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*{_DOT_SIGN}))(?=[A-Za-z0-9])"
)
_DOT = re.compile(rf"(?i)(?<=[A-Za-z0-9]){_DOT_SIGN}(?=[A-Za-z0-9])")
_HINT = re.compile(rf"(?i)(?:[\[({{<]|{_GAP})(?:at|@|dot)(?:[\])}}>]|{_GAP})|[\[({{<]{_GAP}{{0,3}}(?:at|@|dot|\.){_GAP}{{0,3}}[\])}}>]")
#: Character references of the signs.
_REFERENCE = re.compile("(?i)&(?:#0*64|#x0*40|commat);|&(?:#0*46|#x0*2e|period);|&(?:#0*43|#x0*2b|plus);")
_REFERRED = {"64": "@", "40": "@", "commat": "@", "46": ".", "2e": ".", "period": ".", "43": "+", "2b": "+", "plus": "+"}
#: The sign of a phone number that is spelled out.
_PLUS = re.compile(
    rf"(?i)(?<![A-Za-z0-9])plus{_GAP}{{1,3}}(?={_NUMERAL}(?:[\x20.-]{{1,3}}{_NUMERAL}){{6}})"
)


class _Tape:
    """A text with, for every character, the source span it stands for."""

    def __init__(self, text: str, starts=None, ends=None):
        self.text = text
        self.starts = range(len(text)) if starts is None else starts
        self.ends = range(1, len(text) + 1) if ends is None else ends

    def fold(self) -> "_Tape":
        """Look-alikes one for one; characters of no width disappear."""
        if not _STRANGE.search(self.text):
            return self
        text = self.text.translate(_TABLE)
        if not any(h in text for h in _HIDDEN):
            return _Tape(text, self.starts, self.ends)
        kept = [i for i, c in enumerate(text) if c not in _HIDDEN]
        return _Tape(
            "".join(text[i] for i in kept), [self.starts[i] for i in kept], [self.ends[i] for i in kept]
        )

    def rewrite(self, pattern: re.Pattern, put) -> "_Tape":
        """Replace each match by what ``put`` yields: (text, from, to) within the match."""
        out, starts, ends, last = [], [], [], 0
        for m in pattern.finditer(self.text):
            out.append(self.text[last : m.start()])
            starts += self.starts[last : m.start()]
            ends += self.ends[last : m.start()]
            for new, s, e in put(m):
                out.append(new)
                starts += [self.starts[s]] * len(new)
                ends += [self.ends[e - 1]] * len(new)
            last = m.end()
        if not last:
            return self
        out.append(self.text[last:])
        return _Tape(
            "".join(out), [*starts, *self.starts[last:]], [*ends, *self.ends[last:]]
        )


def _address(run: str) -> bool:
    """Whether spelled digits are four numbers up to 255 with dots between them."""
    numbers = ["".join(_SPELLED.get(w.lower(), w) for w in _SPOKEN.findall(p)) for p in run.split(".")]
    return len(numbers) == 4 and all(0 < len(n) <= 3 and int(n) <= 255 for n in numbers)


def _digits(m: re.Match) -> Iterator[tuple[str, int, int]]:
    """The digits of a run; the dots of an address stay."""
    address, last = _address(m.group()), m.end()
    for w in _SPOKEN.finditer(m.string, m.start(), m.end()):
        if address and (dot := m.string.find(".", last, w.start())) >= 0:
            yield ".", dot, dot + 1
        yield _SPELLED.get(w.group().lower(), w.group()), w.start(), w.end()
        last = w.end()


def _referred(m: re.Match) -> Iterator[tuple[str, int, int]]:
    name = m.group()[1:-1].lower().lstrip("#x").lstrip("0")
    yield _REFERRED[name], m.start(), m.end()


def _sign(sign: str):
    return lambda m: [(sign, m.start(), m.end())]


def deobfuscated(text: str) -> _Tape | None:
    """The text after all transducers; None if none of them has anything to do."""
    tape = _Tape(text).fold()
    if "&" in tape.text:
        tape = tape.rewrite(_REFERENCE, _referred)
    if _HINT.search(tape.text):
        tape = tape.rewrite(_AT, _sign("@"))
        tape = tape.rewrite(_DOT, _sign("."))
    if "plus" in tape.text.lower():
        tape = tape.rewrite(_PLUS, _sign("+"))
    tape = tape.rewrite(_SPELLING, _digits)
    return None if tape.text == text else tape


def find(text: str) -> tuple[list[Span], list[Span]]:
    """(base, all) spans of a text."""
    base = identifiers(text)
    tape = deobfuscated(text)
    if tape is None:
        return base, base
    more = list(base)
    taken = {k: [s for s in base if s[2] == k] for k in KINDS}
    for start, end, kind in identifiers(tape.text):
        s, e = tape.starts[start], tape.ends[end - 1]
        if not any(a <= s and e <= b for a, b, _ in taken[kind]):
            more.append((s, e, kind))
    return base, ordered(more)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def masked(text: str) -> str:
    """The text with every identifier replaced by its kind in brackets.

    Spans that overlap are masked as one, named after the first.
    """
    out, last = [], 0
    for start, end, kind in find(text)[1]:
        if start >= last:
            out += [text[last:start], f"[{kind.upper()}]"]
        last = max(last, end)
    out.append(text[last:])
    return "".join(out)


def _found(text: Column) -> Column:
    kind = ",".join(f"n_{k}:bigint" for k in KINDS)

    @F.arrow_udf(f"struct<{kind},base_sha256:string,spans:string>")
    def scan(texts: pa.Array) -> pa.Array:
        cells: list[list] = [[] for _ in range(len(KINDS) + 2)]
        for t in texts:
            base, every = find(t.as_py())
            for i, k in enumerate(KINDS):
                cells[i].append(sum(s[2] == k for s in base))
            cells[-2].append(hashlib.sha256(joined(base).encode()).hexdigest())
            cells[-1].append(joined(every))
        kinds = [pa.int64()] * len(KINDS) + [pa.string()] * 2
        names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cells, kinds)], names)

    return scan(text)


def scanned(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, counts per kind, digest of the base spans, all spans."""
    rows = docs.select(common.field("doc_id").alias("doc_id"), _found(common.text_of()).alias("v"))
    return rows.select("doc_id", "v.*")


def mask(docs: DataFrame) -> DataFrame:
    """The documents with identifiers masked and ``n_chars``, where present, counted anew.

    A NULL text stays NULL; rows and other columns stay as they are.
    """

    @F.arrow_udf("string")
    def cover(texts: pa.Array) -> pa.Array:
        got = [t.as_py() for t in texts]
        return pa.array([None if t is None else masked(t) for t in got], pa.string())

    rows = common.packed(docs).withColumn("covered", cover(F.col("doc").getField("text")))
    new = {"text": F.col("covered"), "n_chars": F.char_length("covered").cast("bigint")}
    old = F.col("doc")
    return rows.select(*[new.get(c, old.getField(c)).alias(c) for c in docs.columns])
