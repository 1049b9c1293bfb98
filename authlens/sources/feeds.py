"""News feeds: RSS 2.0 and Atom documents into article rows."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ARTICLE = "struct<url: string, title: string, description: string, category: string, published: timestamp>"
FEED = f"feed string, mode string, found int, kept int, error string, articles array<{ARTICLE}>"
_TAG, _FIRST = re.compile(r"<[^>]*>"), re.compile(r"<p[^>]*>(.*?)</p>", re.I | re.S)


def description_of(text: str | None, first_paragraph: bool) -> str | None:
    """A description without tags; of a feed that wraps it, the first paragraph."""
    if not text:
        return None
    inner = _FIRST.search(text) if first_paragraph else None
    return _TAG.sub("", inner.group(1) if inner else text).strip() or None


def moment(text: str | None) -> datetime | None:
    """A date as mail headers or ISO 8601 write it, in UTC; without a zone it is UTC, and what is neither is null."""
    for read in (parsedate_to_datetime, lambda s: datetime.fromisoformat(s.replace("Z", "+00:00"))):
        try:
            at = read((text or "").strip())
        except (TypeError, ValueError, IndexError):
            continue
        return (at if at.tzinfo else at.replace(tzinfo=UTC)).astimezone(UTC).replace(tzinfo=None)
    return None


def _named(node: ET.Element, name: str) -> list[ET.Element]:
    return [c for c in node if c.tag.rpartition("}")[2] == name]


def _text(node: ET.Element, name: str) -> str | None:
    first = next(iter(_named(node, name)), None)
    return (first.text or "").strip() or None if first is not None else None


def read_feed(xml: str | None, feed: str, keep: str | None = None) -> tuple:
    """mode (rss, atom, unknown, broken), found, kept, error, articles of one document. An item's url falls back to its id, its title to its url; items without either are left out, as are those whose url ``keep`` is not found in."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError as e:
        return "broken", 0, 0, str(e), []
    kind, wrapped = root.tag.rpartition("}")[2], "zaobao" in feed.lower()
    if kind == "rss":
        channel = next(iter(_named(root, "channel")), root)
        items = _named(channel, "item")
        rows = [
            (_text(i, "link") or _text(i, "guid") or "", _text(i, "title"), _text(i, "description"), ", ".join(c for c in ((x.text or "").strip() for x in _named(i, "category")) if c) or None, _text(i, "pubDate"))
            for i in items
        ]
    elif kind == "feed":
        items = _named(root, "entry")
        links = [next((h for x in _named(i, "link") if (h := (x.get("href") or "").strip())), None) for i in items]
        rows = [(h or _text(i, "id") or "", _text(i, "title"), _text(i, "description"), None, _text(i, "published") or _text(i, "updated")) for i, h in zip(items, links)]
    else:
        return "unknown", 0, 0, None, []
    wanted = re.compile(keep) if keep else None
    out = [(u.strip(), t or u, description_of(x, wrapped), c, moment(p)) for u, t, x, c, p in rows if u.strip() and (wanted is None or wanted.search(u))]
    return {"feed": "atom"}.get(kind, kind), len(items), len(out), None, out


def parse_feeds(documents: DataFrame) -> DataFrame:
    """feed, mode, found, kept, error, articles of feed documents (feed: address, xml, keep: pattern or null). A broken document is a row with its error, never a failure; null is an empty one."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fields = ("url", "title", "description", "category", "published")
        for b in batches:
            rows = []
            for feed, xml, keep in b[["feed", "xml", "keep"]].itertuples(index=False, name=None):
                mode, found, kept, error, articles = read_feed(xml, feed or "", keep)
                rows.append((feed, mode, found, kept, error, [dict(zip(fields, a)) for a in articles]))
            yield pd.DataFrame(rows, columns=["feed", "mode", "found", "kept", "error", "articles"])

    return documents.mapInPandas(read, FEED)


def feed_articles(parsed: DataFrame) -> DataFrame:
    return parsed.select("feed", F.explode("articles").alias("a")).select("feed", "a.*")


def parse_date(c: Column) -> Column:
    """:func:`moment` in the JVM, for columns of dates: mail form with a zone's offset or GMT, or ISO 8601."""
    bare = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3,9},\s*", "")
    mail = F.regexp_replace(bare, r"\s+(?:GMT|UTC|UT|Z)$", " +0000")
    iso = F.regexp_replace(F.trim(c), "Z$", "+00:00")
    zoned = F.when(iso.rlike(r"[+-]\d\d:?\d\d$"), iso).otherwise(F.concat(iso, F.lit("+00:00")))
    return F.coalesce(F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss Z")), F.when(iso.rlike(r"^\d{4}-\d\d-\d\d"), zoned.try_cast("timestamp")))


def feed_gaps(parsed: DataFrame, held: DataFrame) -> DataFrame:
    """feed, items, fresh, gap of each feed: whether every item is new (``held``: url), so that some may have been missed between two readings."""
    a = feed_articles(parsed).join(held.select("url").distinct().withColumn("_held", F.lit(True)), "url", "left")
    return a.groupBy("feed").agg(F.count("*").alias("items"), F.count(F.when(F.col("_held").isNull(), 1)).alias("fresh")).withColumn("gap", F.col("items") == F.col("fresh"))


def new_ids(rows: DataFrame, held: DataFrame, order: list[Column], key: str = "url", ident: str = "id") -> DataFrame:
    """Rows whose ``key`` is not held, once a key, with ids that go on from the largest held, in the given order."""
    from ..operators.cards import ordered_positions

    w = Window.partitionBy(key).orderBy(*order)
    fresh = rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n").join(held.select(key).distinct(), key, "left_anti")
    last = F.broadcast(held.agg(F.coalesce(F.max(ident), F.lit(0)).alias("_last")))
    return ordered_positions(fresh, [*order, F.col(key)], "_at").join(last, F.lit(True)).withColumn(ident, F.col("_last") + F.col("_at") + 1).drop("_last", "_at")
