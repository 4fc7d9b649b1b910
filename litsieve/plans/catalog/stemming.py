"""The published stemming rules in SQL, step by step over distinct words."""

from __future__ import annotations

_VOWEL, _OTHER = "[aeiouy]", "[^aeiouy]"
_SHORT = f"({_OTHER}{_VOWEL}[^aeiouywxY]|^{_VOWEL}{_OTHER})$"

# Fixed values of the published algorithm.
_WHOLE = """skis ski skies sky dying die lying lie tying tie idly idl gently gentl ugly ugli early earli only onli
    singly singl sky sky news news howe howe atlas atlas cosmos cosmos bias bias andes andes""".split()
_KEPT = "inning outing canning herring earring proceed exceed succeed".split()
_STEP_2 = """tional tion enci ence anci ance abli able entli ent izer ize ization ize ational ate ation ate ator ate
    alism al aliti al alli al fulness ful ousli ous ousness ous iveness ive iviti ive biliti ble bli ble
    ogi og fulli ful lessli less li -""".split()
_STEP_3 = "tional tion ational ate alize al icate ic iciti ic ical ic ful - ness - ative -".split()
_STEP_4 = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()


def _ending(column: str, names: list[str]) -> str:
    """The longest of the names that ends a word, or the empty text."""
    longest_first = sorted(set(names), key=lambda n: (-len(n), n))
    return f"regexp_extract({column}, '({'|'.join(longest_first)})$', 1)"


def _case(column: str, pairs: list[str]) -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{'' if b == '-' else b}'" for a, b in zip(pairs[::2], pairs[1::2]))
    return f"CASE {column} {whens} END"


def _in(names: list[str]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def stem_ctes(words: str) -> dict[str, str]:
    """CTEs up to ``stems`` (word, stem) of the distinct lower-case words in table ``words`` (word)."""
    region = f"regexp_extract({{0}}, '^.*?{_VOWEL}{_OTHER}')"
    return {
        "st_y": f"""SELECT word, regexp_replace(regexp_replace(word, '^y', 'Y'), '({_VOWEL})y', '\\1Y', 'g') AS w,
            CASE WHEN length(word) <= 2 THEN word ELSE {_case('word', _WHOLE)} END AS fixed
          FROM (SELECT DISTINCT word FROM {words}) d""",
        "st_r1": f"""SELECT *, CASE WHEN regexp_matches(w, '^(gener|commun|arsen)') THEN length(regexp_extract(w, '^(gener|commun|arsen)'))
            WHEN {region.format('w')} <> '' THEN length({region.format('w')}) ELSE length(w) END AS r1 FROM st_y""",
        "st_r2": f"""SELECT *, CASE WHEN {region.format('substr(w, r1 + 1)')} <> ''
            THEN r1 + length({region.format('substr(w, r1 + 1)')}) ELSE length(w) END AS r2 FROM st_r1""",
        "st_1a": f"""SELECT word, fixed, r1, r2, CASE WHEN w LIKE '%sses' THEN w[:-3]
            WHEN w LIKE '%ied' OR w LIKE '%ies' THEN CASE WHEN length(w) > 4 THEN w[:-3] ELSE w[:-2] END
            WHEN w LIKE '%s' AND w NOT LIKE '%us' AND w NOT LIKE '%ss' AND regexp_matches(w[:-3], '{_VOWEL}') THEN w[:-2]
            ELSE w END AS w FROM st_r2""",
        "st_end": f"""SELECT word, r1, r2, w, coalesce(fixed, CASE WHEN w IN {_in(_KEPT)} THEN w END) AS fixed,
            regexp_extract(w, 'eed(ly)?$') AS eed, regexp_extract(w, '(edly|ed|ingly|ing)$') AS past FROM st_1a""",
        "st_cut": f"""SELECT word, r1, r2, fixed, w, CASE WHEN eed <> '' THEN
              CASE WHEN length(w) - length(eed) >= r1 THEN substr(w, 1, length(w) - length(eed)) || 'ee' ELSE w END END AS with_eed,
            CASE WHEN past <> '' AND regexp_matches(substr(w, 1, length(w) - length(past)), '{_VOWEL}')
              THEN substr(w, 1, length(w) - length(past)) END AS b FROM st_end""",
        "st_1b": f"""SELECT word, r1, r2, fixed, CASE WHEN with_eed IS NOT NULL THEN with_eed WHEN b IS NULL THEN w
            WHEN regexp_matches(b, '(at|bl|iz)$') THEN b || 'e'
            WHEN regexp_matches(b, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN b[:-2]
            WHEN r1 >= length(b) AND regexp_matches(b, '{_SHORT}') THEN b || 'e' ELSE b END AS w FROM st_cut""",
        "st_1c": f"""SELECT word, r1, r2, fixed, regexp_replace(w, '(.{_OTHER})[yY]$', '\\1i') AS w FROM st_1b""",
        "st_2e": f"SELECT *, {_ending('w', _STEP_2[::2])} AS e FROM st_1c",
        "st_2": f"""SELECT word, r1, r2, fixed, CASE WHEN e <> '' AND length(w) - length(e) >= r1
              AND (e <> 'ogi' OR w LIKE '%logi') AND (e <> 'li' OR regexp_matches(w, '[cdeghkmnrt]li$'))
            THEN substr(w, 1, length(w) - length(e)) || {_case('e', _STEP_2)} ELSE w END AS w FROM st_2e""",
        "st_3e": f"SELECT *, {_ending('w', _STEP_3[::2])} AS e FROM st_2",
        "st_3": f"""SELECT word, r1, r2, fixed, CASE WHEN e <> '' AND length(w) - length(e) >= CASE WHEN e = 'ative' THEN r2 ELSE r1 END
            THEN substr(w, 1, length(w) - length(e)) || {_case('e', _STEP_3)} ELSE w END AS w FROM st_3e""",
        "st_4e": f"SELECT *, {_ending('w', _STEP_4)} AS e FROM st_3",
        "st_4": """SELECT word, r1, r2, fixed, CASE WHEN e <> '' AND length(w) - length(e) >= r2
              AND (e <> 'ion' OR regexp_matches(w, '[st]ion$'))
            THEN substr(w, 1, length(w) - length(e)) ELSE w END AS w FROM st_4e""",
        "stems": f"""SELECT word, coalesce(fixed, lower(CASE
            WHEN w LIKE '%e' AND (length(w) > r2 OR (length(w) > r1 AND NOT regexp_matches(w[:-2], '{_SHORT}'))) THEN w[:-2]
            WHEN w LIKE '%ll' AND length(w) > r2 THEN w[:-2] ELSE w END)) AS stem FROM st_4""",
    }
