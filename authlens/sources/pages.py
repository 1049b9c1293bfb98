"""Pages and sitemaps: addresses, metadata and the text of an article."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.names import WS, collapse

# Elements that hold no article text, phrases that are not the article's, least lengths, and where a page states its own data.
SKIPPED = ("script", "style", "nav", "header", "footer", "aside", "form", "figure")
NOISE = ("Sign up now: Get ST's newsletters delivered to your inbox", "Read this subscriber-only article for free!")
LEAST, LEAST_DENSE, OPENING = 400, 150, 280
META = {
    "title": (r'<meta property="og:title" content="([^"]*)"', r"<title>(.*?)</title>"),
    "description": (r'<meta property="og:description" content="([^"]*)"', r'<meta name="description" content="([^"]*)"'),
    "published": (r'"datePublished":\s*"([^"]+)"', r'<meta property="article:published_time" content="([^"]*)"'),
    "category": (r'<meta property="article:section" content="([^"]*)"',),
}
ESCAPES = (("&amp;", "&"), ("&quot;", '"'), ("&#039;", "'"), ("&#39;", "'"))


class _Paragraphs(HTMLParser):
    """Texts of the paragraphs outside skipped elements; an open paragraph ends where the next begins."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.skip, self.inside, self.parts, self.found = 0, False, [], []

    def close_paragraph(self) -> None:
        if self.inside:
            self.found.append(" ".join(p.strip() for p in self.parts if p.strip()))
        self.inside, self.parts = False, []

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.skip += 1
        elif tag == "p" and not self.skip:
            self.close_paragraph()
            self.inside = True

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif tag == "p":
            self.close_paragraph()

    def handle_data(self, data):
        if self.inside and not self.skip:
            self.parts.append(data)


def _page_text(html: str | None) -> str | None:
    if html is None:
        return None
    p = _Paragraphs()
    p.feed(html)
    p.close()
    p.close_paragraph()
    text = " ".join(" ".join(p.found).split())
    for phrase in NOISE:
        text = text.replace(phrase, "")
    return " ".join(text.split())


@F.pandas_udf(StringType())
def page_text(html: pd.Series) -> pd.Series:
    """The paragraphs of a page as one line of text, boilerplate removed; null stays null."""
    return html.map(_page_text)


def dense_share_high(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\x{3400}-\x{9FFF}]", "")) * 2 > F.length(c)


def minimum_for(c: Column) -> Column:
    """The shortest text that is an article: less where more than half of it is ideographs."""
    return F.when(dense_share_high(c), LEAST_DENSE).otherwise(LEAST)


def body_error(c: Column, least_whole: Column | None = None) -> Column:
    """``missing``, ``short`` or ``partial`` (under what the outlet's whole texts have), null for a usable text."""
    n = F.length(c)
    out = F.when(c.isNull() | (n == 0), "missing").when(n < minimum_for(c), "short")
    return out if least_whole is None else out.when(n < least_whole, "partial")


def page_meta(html: Column) -> Column:
    """Struct of title, description, published (day) and category as the page itself states them."""

    def first(name: str) -> Column:
        found = F.coalesce(*[F.when(html.rlike("(?s)" + p), F.regexp_extract(html, "(?s)" + p, 1)) for p in META[name]])
        v = collapse(found)
        for a, b in ESCAPES:
            v = F.replace(v, F.lit(a), F.lit(b))
        return (F.substring(v, 1, 10) if name == "published" else v).alias(name)

    return F.struct(*[first(n) for n in META])


def slug_title(url: Column) -> Column:
    """A headline from an address: its last part with spaces for hyphens and a capital first."""
    last = F.split(F.substring_index(F.regexp_replace(url, "/+$", ""), "/", -1), r"\?")[0]
    words = F.trim(F.replace(last, F.lit("-"), F.lit(" ")))
    return F.concat(F.upper(F.substring(words, 1, 1)), F.substring(words, 2, 100_000))


def section_of(url: Column) -> Column:
    """The path between host and last part, or the only part."""
    path = F.regexp_replace(F.split(F.regexp_replace(url, "^https?://[^/]+/", ""), r"\?")[0], "^/+|/+$", "")
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/")).otherwise(parts[0])


def sitemap_rows(maps: DataFrame) -> DataFrame:
    """source, url (no query), category, published, month of the entries of sitemaps (source, month, xml, keep: a pattern its urls must hold, or null). Entries without an address are left out."""
    one = lambda name: F.nullif(F.trim(F.regexp_extract("block", f"(?s)<{name}>(.*?)</{name}>", 1)), F.lit(""))
    b = maps.select("source", "month", "keep", F.explode(F.regexp_extract_all("xml", F.lit(r"(?s)<url>(.*?)</url>"), F.lit(1))).alias("block"))
    b = b.select("source", "month", "keep", F.split(one("loc"), r"\?")[0].alias("url"), F.substring(one("lastmod"), 1, 10).alias("published")).filter("url is not null")
    return b.filter(F.col("keep").isNull() | F.expr("url rlike keep")).select("source", "url", section_of(F.col("url")).alias("category"), "published", "month")


def index_body(parts: Column) -> Column:
    """An index hit's paragraphs (ARRAY) as text: joined by blank lines, or by nothing where they are single letters."""
    p = F.filter(F.coalesce(parts, F.array().cast("array<string>")), lambda x: x.isNotNull())
    letters = F.aggregate(p, F.lit(0), lambda s, x: s + F.length(x))
    stripped = F.filter(F.transform(p, lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(p) == 0, "").when(letters <= 2 * F.size(p), F.trim(F.array_join(p, ""))).otherwise(F.array_join(stripped, "\n\n"))


def opening(c: Column, limit: int = OPENING) -> Column:
    """The first sentences of a text within ``limit`` characters: cut after the last end of a sentence in its second half, else after a word, with an ellipsis."""
    text = collapse(c)
    cut = F.substring(text, 1, limit)
    last = lambda mark: F.when(cut.contains(mark), F.length(cut) - F.length(F.substring_index(cut, mark, -1)) - len(mark) + 1).otherwise(0)
    end = F.greatest(*[last(m) for m in (". ", "。", "! ", "? ")])
    word = F.when(cut.contains(" "), F.substring(cut, F.lit(1), F.length(cut) - F.length(F.substring_index(cut, " ", -1)) - 1)).otherwise(cut)
    return F.when(F.length(text) <= limit, text).when(end - 1 > limit // 2, F.trim(F.substring(cut, F.lit(1), end))).otherwise(F.concat(word, F.lit("…")))


def months(first: Column, last: Column) -> Column:
    """The months from one date to another, inclusive, as YYYY-MM; none where the last comes first."""
    a, b = F.trunc(first, "month"), F.trunc(last, "month")
    return F.when(a <= b, F.transform(F.sequence(a, b, F.expr("interval 1 month")), lambda m: F.date_format(m, "yyyy-MM"))).otherwise(F.array().cast("array<string>"))


def month_bounds(month: Column) -> Column:
    """Struct of the first and last second (Unix) of a month (YYYY-MM), UTC."""
    a = F.to_date(F.concat(month, F.lit("-01")))
    days = lambda c: F.unix_date(c).cast("long") * 86_400
    return F.struct(days(a).alias("first"), (days(F.add_months(a, 1)) - 1).alias("last"))


def filled(rows: DataFrame, bodies: DataFrame) -> DataFrame:
    """``rows`` (url, source, ...) with body, error from fetched ``bodies`` (url, body, error): an empty text where nothing was fetched."""
    b = bodies.groupBy("url").agg(F.max("body").alias("body"), F.max("error").alias("error"))
    return rows.join(b, "url", "left").withColumn("body", F.coalesce("body", F.lit(""))).withColumn("error", F.coalesce("error", F.lit("")))


