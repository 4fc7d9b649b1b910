"""One-pass rewriting of domain tokens ("knock out" -> "knock_out").

All mappings form one alternation; at each position the first mapping that
matches wins, and the replaced text is never looked at again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from litsieve.functions.clean import ANY_SPACE, NON_SPACE, URL, clean_tokens

# ---------------------------------------------------------------------------
# The token dictionaries. Their order is part of the rule.
TUMOR_WORDS = [
    "tumor", "tumour", "hepatoma", "melanoma", "teratoma", "thymoma", "neoplasia", "neoplasm",
]
TUMOR_ENDINGS = ["[a-z]+inoma", "[a-z]+gioma", "[a-z]+ocytoma", "[a-z]+thelioma"]
TUMOR_WORDS_OR_ENDINGS = [
    "[a-z]*adenoma", "[a-z]*sarcoma", "[a-z]*lymphoma", "[a-z]*papilloma", "[a-z]*leukemia",
    "[a-z]*leukaemia", "[a-z]*blastoma", "[a-z]*lipoma", "[a-z]*myoma", "[a-z]*acanthoma",
    "[a-z]*fibroma", "[a-z]*glioma",
]
CELL_LINE_PREFIXES = [
    "B-?16", "DA", "Hepa1", "K-?1735", "L5178Y", "MCA", "MCF-7", "MDA-MB", "NFS", "NIH-3T3",
    "P1798", "P19", "P388", "PC4", "RAW117", "RIF", "RMA", "SP2/0", "WEHI",
]
CELL_LINE_NAMES = [
    "1246", "14-122", "14-166", "14-259", "15-299", "1C11", "203 cells", "2C3", "320DM", "32D",
    "38C13", "38C13", "3LL", "3SB", "4T1", "7-M12", "7OZ/3", "82-132", "A20", "A431", "A549",
    "AB1", "AC29", "ADJ-PC-5", "AKR1", "BAL17.7.1", "BCL1", "Bac-1.2F5", "C10", "C1300",
    "C1300-NB", "C1498", "C26", "C4", "C6", "C6", "CB101", "COLO", "CT-2A", "CT26", "CT51",
    "Caco-2", "Comma D", "D1-DMBA-3", "D5", "E3", "E6496", "EL-4", "EL4", "ELM-D", "EMT6",
    "EPEN", "ESb", "F3II", "FSA", "FSa-II", "GL26", "GL261", "GL261", "Gc-4", "H1299",
    "HCT-116", "HCT-8", "HL-60", "HM7", "HT-29", "HT29", "HTH-K", "HeLa", "HepG2", "J558",
    "J558L", "JBS", "Jurkat", "K36", "K562", "L1", "L1210", "L929", "LA-N-2", "LK35.2", "LLC",
    "LM2", "LM2", "LM3", "LMM3", "LS 174T", "LSA", "LSTRA", "Lewis lung", "M1", "MA13/C",
    "MA16/C", "MA44", "MAC13", "MAC16", "MAC26", "MC-38", "MC12", "MCa-29", "MCa-4", "MDA231",
    "MEL cells", "MH134", "MIN6", "MLE", "MM3", "MO5", "MOD", "MOPC315", "N18", "N18TG2",
    "N1E-115", "N2A", "NBFL", "NL17", "NL22", "NL4", "NR-S1", "Nb2", "Neuro-2A", "OTT6050",
    "P02", "P03", "P511", "P815", "PC-3", "PC12", "PCC4", "R1.1", "RB13", "RENCA", "RI-4-11",
    "RL-12", "RM-1", "RVC", "RcsX", "S49", "SC-115", "SC115", "SCCVII", "SK-CO-1", "SL12",
    "SMA-560", "SW403", "SW480", "SW620", "Saos-2", "T-47D", "T241", "TA3/St", "TBJ-NB",
    "TEPC-2027", "TK-1", "TSA", "UV2237M", "WiDr", "X63-Ag8.653", "Y1", "YAC-1", "sarcoma 180",
]
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Mapping:
    """A regex without capturing groups, and the text that replaces it.

    ``guard`` is a look-ahead every match satisfies; it spares most words the
    full regex.
    """

    name: str
    regex: str
    replacement: str
    guard: str = ""


def _by_first_character(words: list[str]) -> str:
    """Alternation of the words in order, looked up by first character.

    Words that differ in it exclude each other, so their order is free; the ones
    that share it stay in order.
    """
    rest: dict[str, list[str]] = {}
    for word in words:
        rest.setdefault(word[0].lower(), []).append(word[1:])
    return "|".join(f"{first}(?:{'|'.join(tails)})" for first, tails in rest.items())


def mappings(dictionary: str = "exact", space: str = ANY_SPACE,
             non_space: str = NON_SPACE) -> list[Mapping]:
    """The ordered mappings.

    ``exact`` takes dictionary names as regexes, as published, so the dot of
    "R1.1" matches any character; ``escaped`` takes them literally.
    """
    if dictionary not in ("exact", "escaped"):
        raise ValueError(f"unknown dictionary {dictionary!r}")
    names = CELL_LINE_NAMES
    if dictionary == "escaped":
        names = [n.replace(".", r"\.") for n in names]
    tumor_words = TUMOR_WORDS + TUMOR_ENDINGS + TUMOR_WORDS_OR_ENDINGS
    tumor = "|".join(tumor_words)
    # a word with the last letters of any tumor word
    tumor_tail = "|".join(sorted({w[-3:] for w in tumor_words}))
    gap = f"(?:{space}|-)"
    # Mapping patterns and replacements, in order of precedence.
    return [
        Mapping("tt", f"(?:{tumor})s?", "tumor_type", f"(?=[a-z]++(?<=(?:{tumor_tail})s?))"),
        Mapping(
            "cl", f"(?:{_by_first_character(CELL_LINE_PREFIXES)}){non_space}*", "cell_line",
            r"(?=\w)",
        ),
        Mapping("cn", _by_first_character(names), "cell_line", r"(?=\w)"),
        Mapping("mice", "mouse|mous|murine", "mice"),
        Mapping("ko", f"ko|knock(?:ed|s)?{gap}?outs?", "knock_out"),
        Mapping("ki", f"knock(?:ed)?{gap}?ins?", "knock_in"),
        Mapping("gt", f"gene{gap}?trap(?:ped|s)?", "gene_trap"),
        Mapping("wt", f"wt|wild{gap}?types?", "wild_type"),
        Mapping("mut", r"\W*-/-\W*", " mut_mut "),
        Mapping("eday", r"e[ ]?\d\d?|e(?:mbryonic)? day[ ]\d\d?", "embryonic_day"),
        Mapping("ee", f"(?:[1,2,4,8]|one){gap}cell|blastocysts?", "early_embryo"),
        Mapping("fig", "fig", "figure"),
        Mapping("letdig", r"[abcdfghs]\d", ""),
    ]


# Two Unicode noncharacters that frame a hit and separate its capture groups.
_EDGE = "\uFDD0"
_SLOT = "\uFDD1"


def _alternation(rules: list[Mapping]) -> str:
    """One Java pattern, capture group i = mapping i.

    The rule restarts at the end of each hit as if the text began there, where
    no word boundary precedes a non-word character; hence ``(?!\\G\\W)``.
    The boundaries around the alternation are those of every alternative.
    """
    for m in rules:
        if re.compile(m.regex).groups:
            raise ValueError(f"mapping {m.name!r} must not capture groups")
    return r"(?i)\b(?!\G\W)(?:" + "|".join(f"{m.guard}({m.regex})" for m in rules) + r")\b"


def rewrite(text: Column, rules: list[Mapping] | None = None) -> Column:
    """Rewrite the text in one pass of the alternation.

    The pass frames every hit and lays out its capture groups in slots, all but
    one of them empty; the filled slot's number picks the replacement.
    """
    rules = mappings() if rules is None else rules
    pattern = _alternation(rules)
    replacements = F.array(*[F.lit(m.replacement) for m in rules])

    framed = F.regexp_replace(
        text,
        F.lit(pattern),
        F.lit(_EDGE + _SLOT.join(f"${i + 1}" for i in range(len(rules))) + _EDGE),
    )

    def fill(part: Column, i: Column) -> Column:
        slot = F.length(part) - F.length(F.ltrim(part, F.lit(_SLOT)))
        return F.when(i % 2 == 0, part).otherwise(F.element_at(replacements, slot + 1))

    by_frames = F.array_join(F.transform(F.split(framed, _EDGE), fill), "")
    # A text that holds the framing characters itself takes several scans.
    return F.when(text.contains(_EDGE) | text.contains(_SLOT), _rewrite_by_scans(text, rules, pattern)).otherwise(
        by_frames
    )


def _rewrite_by_scans(text: Column, rules: list[Mapping], pattern: str) -> Column:
    """As :func:`rewrite` for any text, with one scan per mapping."""
    groups = [
        F.regexp_extract_all(text, F.lit(pattern), F.lit(i + 1)) for i in range(len(rules))
    ]
    replaced = F.transform(groups[0], lambda _: F.lit(""))
    for group, m in zip(groups, rules):
        replaced = F.zip_with(replaced, group, _choose(m.replacement))
    return F.array_join(
        F.flatten(
            F.zip_with(
                F.split(text, pattern, -1), replaced,
                lambda piece, new: F.array(piece, F.coalesce(new, F.lit(""))),
            )
        ),
        "",
    )


def _choose(replacement: str):
    return lambda done, hit: F.when(hit != "", F.lit(replacement)).otherwise(done)


def clean_without_stem(text: Column, rules: list[Mapping] | None = None) -> Column:
    """Drop URLs; rewrite, lower-case and tokenise each piece between them."""
    return F.array_join(
        F.transform(F.split(text, URL), lambda piece: clean_tokens(rewrite(piece, rules))), ""
    )


def clean_and_stem(text: Column, rules: list[Mapping] | None = None) -> Column:
    """The default preprocessing: :func:`clean_without_stem`, then stemming."""
    from litsieve.functions.stem import stem_words

    return stem_words(clean_without_stem(text, rules))
