"""SQL expressions of the rules on names and values, written from the rules and not from the column functions."""

from __future__ import annotations

# See functions/names.py; here in RE2's notation.
WS = r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
YEAR = r"\(?\b(?:18|19|20)\d{2}\b\)?"
END_YEAR = r"\s*\((?:18|19|20)\d{2}\)\s*$"
FIRST_ORIGINAL = r"^([^()]*[^\x00-\x7F][^()]*?)\s*\(([^()]+(?:\([^()]*\)[^()]*)*)\)\s*$"
FIRST_GLOSS = r"^([^()]*[A-Za-z][^()]*?)\s*\(([^()]*[\x{3400}-\x{9FFF}][^()]*)\)\s*$"
STYLE = r"^singapore\.?\s+|\s*\(singapore\)$|\s*\([a-z]{2,6}\)|^the\s+|,?\s+singapore$"
ABBREVIATION = r"\b(Mr|Mrs|Ms|Dr|Prof|St|No|Co|Ltd|Pte|Inc|Jr|Sr|vs|approx)\."
COMMON = "the and for with from that this was has have had his her its into also are were been will who which their they them than then there she him"


def sub(c: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({c}, '{pattern.replace(chr(39), chr(39) * 2)}', '{to}', 'g')"


def tight(c: str) -> str:
    return f"trim({sub(c, WS + '+', ' ')}, ' ')"


def low(c: str) -> str:
    return f"replace(lower({c}), 'ß', 'ss')"


def plain(c: str) -> str:
    return tight(low(f"replace(replace(replace(replace({c}, '‘', ''''), '’', ''''), '“', '\"'), '”', '\"')"))


def house(c: str) -> str:
    n = f"trim({sub(plain(c), STYLE)}, ' ')"
    n = sub(sub(sub(n, r"\s*&\s*", " and "), r"'s\b"), r"\bawards\b", "award")
    return f"trim({sub(n, r'[^\p{L}\p{N}_]+', ' ')}, ' ')"


def value_key(c: str) -> str:
    return f"coalesce(nullif({house(c)}, ''), {plain(c)})"


def no_year(c: str) -> str:
    return tight(sub(c, YEAR))


def end_year(c: str) -> str:
    return f"trim(regexp_extract({c}, '({END_YEAR})', 1), ' ')"


def tries(c: str) -> str:
    n = no_year(c)
    pick = lambda p, i: f"trim(regexp_extract({n}, '{p}', {i}), ' ')"
    return (
        f"case when regexp_matches({n}, '{FIRST_ORIGINAL}') then [{pick(FIRST_ORIGINAL, 1)}, {pick(FIRST_ORIGINAL, 2)}] "
        f"when regexp_matches({n}, '{FIRST_GLOSS}') then [{pick(FIRST_GLOSS, 2)}, {pick(FIRST_GLOSS, 1)}] else [{n}] end"
    )


def parts(c: str) -> str:
    return f"list_filter(list_transform(string_split(coalesce({c}, ''), ' | '), lambda x: trim(x, ' ')), lambda x: x <> '')"


def gloss(c: str) -> str:
    inner = rf"regexp_extract({sub(c, END_YEAR)}, '\(([^()]*[A-Za-z][^()]*)\)\s*$', 1)"
    return f"case when {inner} <> '' then trim({inner}, ' ') || case when {end_year(c)} <> '' then ' ' || {end_year(c)} else '' end else trim({c}, ' ') end"


def loose(c: str) -> str:
    return sub(tight(sub(low(c), r"\p{P}", " ")), "^the (.)", r"\1")


def content(c: str) -> str:
    words = "['" + "', '".join(COMMON.split()) + "']"
    return f"list_filter(list_distinct(regexp_extract_all({low(c)}, '[\\p{{L}}\\p{{N}}_''-]+')), lambda x: len(x) > 2 and not list_contains({words}, x))"
