"""Column functions on names and on the values of multi-valued fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python splits it, the house style of names, years, and names given in two scripts.
WS = r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
HOUSE_STYLE = r"^singapore\.?\s+|\s*\(singapore\)$|\s*\([a-z]{2,6}\)|^the\s+|,?\s+singapore$"
YEAR = r"\(?\b(?:18|19|20)[0-9]{2}\b\)?"
TRAILING_YEAR = r"\s*\((?:18|19|20)[0-9]{2}\)\s*$"
ORIGINAL_WITH_GLOSS = r"^([^()]*[^\x00-\x7F][^()]*?)\s*\(([^()]+(?:\([^()]*\)[^()]*)*)\)\s*$"
GLOSS_WITH_ORIGINAL = r"^([^()]*[A-Za-z][^()]*?)\s*\(([^()]*[\x{3400}-\x{9FFF}][^()]*)\)\s*$"
NON_LATIN = r"[^\x00-\x{24F}\x{1E00}-\x{1EFF}\x{2000}-\x{206F}]"
IDEOGRAPH = r"[\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}]"
JOINED_LIST = r"([)）])\s*[,，、]\s*([A-Z\x{3400}-\x{9FFF}])"
NOT_AWARDS = ("senior counsel",)
ENGLISH_ONLY = ("Street Address",)
PROSE = ("Description", "Achievements")
COMMON_WORDS = (
    "the and for with from that this was has have had his her its into also are "
    "were been will who which their they them than then there she him"
).split()
NUMBER = r"[0-9][0-9,.]*[0-9]|[0-9]"
DELIMITER = " | "
#: A letter, digit or underscore of any script, as Python counts word characters.
WORDLIKE = r"\p{L}\p{N}_"


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none outside."""
    return F.trim(F.regexp_replace(c, WS + "+", " "))


def fold(c: Column) -> Column:
    """Lower case, with the one letter whose case folding differs in Latin names."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def plain(c: Column) -> Column:
    """A name as a lookup key: case, style of quotes and spacing set aside."""
    return collapse(fold(F.translate(c, "‘’“”", "''\"\"")))


def house(c: Column) -> Column:
    """A name with the authority's house style set aside."""
    n = F.trim(F.regexp_replace(plain(c), HOUSE_STYLE, ""))
    n = F.regexp_replace(n, r"\s*&\s*", " and ")
    n = F.regexp_replace(F.regexp_replace(n, r"'s\b", ""), r"\bawards\b", "award")
    return F.trim(F.regexp_replace(n, f"[^{WORDLIKE}]+", " "))


def without_year(c: Column) -> Column:
    return collapse(F.regexp_replace(c, YEAR, ""))


def trailing_year(c: Column) -> Column:
    """The year in brackets that ends a value, outer spaces dropped; empty where there is none."""
    return F.trim(F.regexp_extract(c, f"({TRAILING_YEAR})", 1))


def renamed(value: Column, name: Column) -> Column:
    """The record's name with the year the value ended in."""
    year = trailing_year(value)
    return F.concat(name, F.when(year != "", F.concat(F.lit(" "), year)).otherwise(""))


def tries_for(c: Column) -> Column:
    """What to look up for one value: the original and its gloss, or the value without its year."""
    n = without_year(c)
    pick = lambda p, i: F.trim(F.regexp_extract(n, p, i))
    return (
        F.when(n.rlike(ORIGINAL_WITH_GLOSS), F.array(pick(ORIGINAL_WITH_GLOSS, 1), pick(ORIGINAL_WITH_GLOSS, 2)))
        .when(n.rlike(GLOSS_WITH_ORIGINAL), F.array(pick(GLOSS_WITH_ORIGINAL, 2), pick(GLOSS_WITH_ORIGINAL, 1)))
        .otherwise(F.array(n))
    )


def values(c: Column) -> Column:
    """The entries of a multi-valued string, trimmed, empties dropped; null has none."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r" \| "), lambda x: F.trim(x)), lambda x: x != "")


def loose_values(c: Column) -> Column:
    """The same split at any bar, lower case, for comparison."""
    return F.filter(F.transform(F.split(fold(F.coalesce(c, F.lit(""))), r"\|"), lambda x: collapse(x)), lambda x: x != "")


def news_values(c: Column) -> Column:
    """Entries as a reader gives them: a list joined by commas after closing brackets is split too."""
    marked = lambda v: F.split(F.regexp_replace(v, JOINED_LIST, "$1\u0001$2"), "\u0001")
    return F.filter(F.transform(F.flatten(F.transform(values(c), marked)), lambda x: F.trim(x)), lambda x: x != "")


def _with_year(text: Column, value: Column) -> Column:
    year = trailing_year(value)
    return F.concat(F.trim(text), F.when(year != "", F.concat(F.lit(" "), year)).otherwise(""))


def gloss(c: Column) -> Column:
    """The English in brackets after an original name, a trailing year kept; else the value."""
    name = F.regexp_replace(c, TRAILING_YEAR, "")
    inner = F.regexp_extract(name, r"\(([^()]*[A-Za-z][^()]*)\)\s*$", 1)
    return F.when(inner != "", _with_year(inner, c)).otherwise(F.trim(c))


def english(c: Column) -> Column:
    """A name given in two scripts, either way round, as its English alone, a trailing year kept; else the value."""
    t = tries_for(c)
    two = (F.size(t) == 2) & t[0].rlike(NON_LATIN) & ~t[1].rlike(NON_LATIN)
    return F.when(two, _with_year(t[1], c)).otherwise(c)


def value_key(c: Column) -> Column:
    """Two values are one where this is equal: house style set aside, digits and years kept."""
    return F.coalesce(F.nullif(house(c), F.lit("")), plain(c))


def family(c: Column) -> Column:
    """The key of a value without its year."""
    return value_key(without_year(c))


def years(c: Column) -> Column:
    """The different years in a value, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"\b((?:18|19|20)[0-9]{2})\b"), F.lit(1))))


def clean_news_value(field: Column, c: Column) -> Column:
    """A reader's value as the authority holds it: lists split, what is no award dropped, English-only fields in English; prose stays."""
    entries = news_values(c)
    awards = F.filter(entries, lambda v: ~value_key(without_year(english(v))).isin(*NOT_AWARDS))
    streets = F.filter(F.transform(entries, gloss), lambda v: ~v.rlike(IDEOGRAPH))
    listed = F.when(field == "Awards", awards).when(field.isin(*ENGLISH_ONLY), streets).otherwise(entries)
    return F.when(field.isin(*PROSE), F.coalesce(c, F.lit(""))).otherwise(F.array_join(listed, DELIMITER))


def loose_name(c: Column) -> Column:
    """A name without case, punctuation and a leading article."""
    return F.regexp_replace(collapse(F.regexp_replace(fold(c), r"\p{P}", " ")), "^the (?=.)", "")


def word_bag(c: Column) -> Column:
    """The words of a name, sorted; equal for names of the same words in any order."""
    return F.array_sort(F.filter(F.split(F.regexp_replace(fold(c), f"[^{WORDLIKE}]+", " "), " "), lambda w: w != ""))


def content_words(c: Column) -> Column:
    """Different words of more than two characters that are not too common."""
    found = F.array_distinct(F.regexp_extract_all(fold(c), F.lit(f"[{WORDLIKE}'-]+"), F.lit(0)))
    return F.filter(found, lambda w: (F.length(w) > 2) & ~w.isin(*COMMON_WORDS))


def fact_tokens(c: Column) -> Column:
    """Content words and each ideograph."""
    return F.array_union(content_words(c), F.regexp_extract_all(c, F.lit(r"[\x{4E00}-\x{9FFF}]"), F.lit(0)))


def near_same(a: Column, b: Column) -> Column:
    """Three quarters of the content words of the poorer of two sentences, three at least, are in the other."""
    x, y = content_words(a), content_words(b)
    small = F.least(F.size(x), F.size(y))
    return (small >= 3) & (F.size(F.array_intersect(x, y)) >= 0.75 * small)


def maybe_same(a: Column, b: Column) -> Column:
    """Two values that may name one thing: the shorter's content words are all in the longer and both end in the same words, or two long sentences are nearly the same; never with different years."""
    ya, yb = years(a), years(b)
    other_years = (F.size(ya) > 0) & (F.size(yb) > 0) & (ya != yb)
    words = lambda c: F.regexp_extract_all(fold(without_year(c)), F.lit(f"[{WORDLIKE}'’-]+"), F.lit(0))
    ta, tb = words(a), words(b)
    first = F.size(ta) <= F.size(tb)
    short, long_ = F.when(first, ta).otherwise(tb), F.when(first, tb).otherwise(ta)
    n = F.least(F.lit(3), F.size(short))
    inside = F.size(F.array_except(content_words(F.array_join(short, " ")), content_words(F.array_join(long_, " ")))) == 0
    tail = lambda t: F.slice(t, F.greatest(F.size(t) - n + 1, F.lit(1)), F.greatest(n, F.lit(1)))
    ends = (F.size(short) > 0) & inside & (tail(short) == tail(long_))
    return ~other_years & (ends | ((F.size(short) >= 10) & near_same(a, b)))


def numbers(c: Column) -> Column:
    """The different numbers in a wording, commas dropped."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(NUMBER), F.lit(0)), lambda x: F.replace(x, F.lit(","), F.lit(""))))


def numbers_differ(a: Column, b: Column) -> Column:
    """Each of two wordings has a number the other lacks."""
    x, y = numbers(a), numbers(b)
    return (F.size(F.array_except(x, y)) > 0) & (F.size(F.array_except(y, x)) > 0)


def result_of(strategy: Column, existing: Column, value: Column) -> Column:
    """What a field (``existing``: array of its entries) holds after a change."""
    joined = F.array_join(F.concat(existing, F.array(value)), DELIMITER)
    return F.when((strategy == "APPEND") & (F.size(existing) > 0), joined).otherwise(value)
