"""Column functions on text: one a rule, none with state."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .names import WS, fold


def strip_tags(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(c, "<[^>]*>", "")), F.lit(""))


# Outlets whose host has a code, and what stays in an outlet's address when it is changed.
OUTLET_ENDS = (("channelnewsasia.com", "cna"), ("straitstimes.com", "st"))
OUTLET_PARTS = (("zaobao", "zaobao"),)


def outlet(url: Column) -> Column:
    """An outlet's code, else the host in lower case without ``www.``."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")
    out = F
    for end, code in OUTLET_ENDS:
        out = out.when(host.endswith(end), code)
    for part, code in OUTLET_PARTS:
        out = out.when(host.contains(part), code)
    return out.otherwise(host)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def section(url: Column) -> Column:
    """The path between host and slug."""
    return F.regexp_extract(path(url), r"^/(.*)/[^/]*$", 1)


def story_key(url: Column) -> Column:
    """What stays the same when an outlet changes an article's address: its number, its story number or its last part, else the path."""
    name, whole = outlet(url), F.regexp_replace(path(url), "/+$", "")
    last = F.substring_index(whole, "/", -1)
    number, story = F.regexp_extract(last, r"-([0-9]{6,})$", 1), F.regexp_extract(whole, r"(story[0-9]{8}-[0-9]+)", 1)
    kept = F.when((name == "cna") & (number != ""), number).when((name == "zaobao") & (story != ""), story).when((name == "st") & (last != ""), last)
    return F.concat(name, F.lit(":"), F.coalesce(kept, whole))


@F.pandas_udf(StringType())
def _unescaped(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))


def title_key(title: Column) -> Column:
    """Entities undone, white space run together, case folded. Only titles with an ampersand leave the JVM: :func:`with_title_key` parts them."""
    return fold(F.trim(F.regexp_replace(title, WS + "+", " ")))


def with_title_key(df: DataFrame, title: str, name: str) -> DataFrame:
    """Adds :func:`title_key` of a column, named and numbered entities undone first."""
    has = F.coalesce(F.col(title).contains("&"), F.lit(False))
    return df.filter(~has).withColumn(name, title_key(F.col(title))).unionByName(df.filter(has).withColumn(name, title_key(_unescaped(F.col(title)))))


def values(c: Column) -> Column:
    """The parts of a multi-valued string, trimmed, empties dropped."""
    return F.filter(F.transform(F.split(c, r"\|"), lambda x: F.trim(x)), lambda x: x != "")


# What may stand before a full stop that ends no sentence, and the number of sentences a description may have.
ABBREVIATION = r"\b(Mr|Mrs|Ms|Dr|Prof|St|No|Co|Ltd|Pte|Inc|Jr|Sr|vs|approx)\."
SENTENCE_LIMIT = 5


def sentences(c: Column) -> Column:
    """A text's sentences: split at white space between a closing mark and a capital, digit, quote or bracket, abbreviations aside."""
    masked = F.regexp_replace(strip_white(F.coalesce(c, F.lit(""))), ABBREVIATION, "$1\u0001")
    each = F.split(masked, rf"(?<=[.!?]){WS}+(?=[A-Z0-9\"'(])")
    return F.transform(F.filter(each, lambda x: strip_white(x) != ""), lambda x: F.replace(x, F.lit("\u0001"), F.lit(".")))


def strip_white(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def sentence_count(c: Column) -> Column:
    return F.size(sentences(c))


def over_limit(old: Column, new: Column) -> Column:
    """Whether a change takes a description past the limit of sentences: more than allowed and more than before."""
    after = sentence_count(new)
    return (after > SENTENCE_LIMIT) & (after > sentence_count(old))


def token_estimate(c: Column) -> Column:
    """Wide characters count one, four others one."""
    wide = F.length(F.regexp_replace(c, r"[^\x{2E80}-\x{9FFF}]", ""))
    return wide + F.ceil((F.length(c) - wide) / 4.0).cast("int")


def grams(c: Column) -> Column:
    """Distinct three-character grams of the lower-case words, two spaces before and one after each."""
    words = F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    each = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(each))


def words(c: Column) -> Column:
    """Lower-case words, punctuation as space."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def word_runs(w: str, low: int = 2, high: int = 6) -> Column:
    """All runs of ``low`` to ``high`` neighbours of the array column ``w``, which must be a stored column, as it is read once a run."""
    n = F.size(w)

    def of(size: int) -> Column:
        run = F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: F.array_join(F.slice(F.col(w), i, F.lit(size)), " "))
        return F.when(n >= size, run).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.array(*[of(size) for size in range(low, high + 1)]))


def dense_runs(s: str, low: int = 3, high: int = 8) -> Column:
    """All runs of ``low`` to ``high`` characters of the column ``s``, a stretch of ideographs; it must be a stored column."""
    n = F.length(s)

    def of(size: int) -> Column:
        run = F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: F.substring(F.col(s), i, F.lit(size)))
        return F.when(n >= size, run).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.array(*[of(size) for size in range(low, high + 1)]))


def name_forms(name: Column) -> Column:
    """The ways a name is printed: as it stands, without brackets, ``last, first`` in both orders, and what follows ``. ``."""
    bare = F.trim(F.regexp_replace(name, r"\s*\([^)]*\)", ""))
    cut = F.split(bare, ",")
    last, rest = cut[0], F.get(cut, F.lit(1))
    dotted = F.when(bare.contains(". "), F.substring(bare, F.instr(bare, ". ") + 2, F.length(bare)))
    return F.array_distinct(F.array_compact(F.array(name, bare, F.concat_ws(" ", rest, last), F.concat_ws(" ", last, rest), dotted)))
