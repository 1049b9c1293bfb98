"""Connected components and near-duplicate stories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import outlet, story_key, with_title_key
from ..scratch import Scratch


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """id, root of nodes (id) under links (a, b): the smallest id that links lead to. Links with an unknown or null end are ignored.

    Each round a node takes the smallest root among its neighbours' and then that root's root, so the number of rounds grows with the logarithm of the longest path.
    """
    tmp = Scratch(links.sparkSession, "components")
    known = links.filter("a <> b").join(nodes.select(F.col("id").alias("a")), "a", "left_semi").join(nodes.select(F.col("id").alias("b")), "b", "left_semi").select("a", "b")
    both = tmp.keep(known.unionAll(known.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    state, turn = tmp.keep(nodes.select("id", F.col("id").alias("root")), "state0"), 0
    while True:
        turn += 1
        low = both.join(state.select(F.col("id").alias("b"), F.col("root").alias("_r")), "b").groupBy(F.col("a").alias("id")).agg(F.min("_r").alias("_r"))
        hop = state.join(low, "id", "left").select("id", "root", F.least("root", F.coalesce("_r", "root")).alias("to"))
        nxt = hop.join(hop.select(F.col("id").alias("to"), F.col("to").alias("_up")), "to", "left")
        nxt = tmp.keep(nxt.select("id", F.least("to", F.coalesce("_up", "to")).alias("root"), F.col("root").alias("was")), f"state{turn}")
        tmp.drop(f"state{turn - 1}")
        state = nxt.select("id", "root")
        if nxt.filter("root <> was").isEmpty():
            return state


def story_copies(articles: DataFrame, days: int = 2, recurring: int = 3) -> DataFrame:
    """id, original: the first article each article retells.

    Articles come in the order of their ids; rows delivered twice are one. An article of a story key seen before is a copy of the key's first article,
    else one whose outlet and title an earlier article within ``days`` has, unless the outlet has used the title on ``recurring`` different days or more (no date is a day too), is a copy of the first such article.
    What that one is a copy of is the original. Every article so has one pointer to an earlier one, and pointers are followed to their end; an article never joins two originals.
    A key or title of a third of all rows is reduced to its first article, or to its different times, before anything is sorted. Null titles fall under the first rule alone.
    """
    a = articles.groupBy("id").agg(F.min("url").alias("url"), F.min("title").alias("title"), F.min(F.coalesce("pubdate", "created_at")).alias("ts"))
    a = with_title_key(a, "title", "t").withColumn("key", story_key(F.col("url"))).withColumn("outlet", outlet(F.col("url")))
    keyed = a.filter("key is not null").groupBy("key").agg(F.min("id").alias("to"))
    first = a.join(keyed, "key").filter("to < id").select("id", "to")
    titled = a.filter("t <> '' and outlet is not null")
    times = titled.groupBy("outlet", "t", "ts").agg(F.min("id").alias("low"))
    day = F.coalesce(F.to_date("ts"), F.lit("0001-01-01").cast("date"))
    used = times.groupBy("outlet", "t").agg(F.countDistinct(day).alias("days")).filter(F.col("days") < recurring)
    span = days * 86_400_000_000
    w = Window.partitionBy("outlet", "t").orderBy("us").rangeBetween(-span, span)
    near = times.filter("ts is not null").join(used, ["outlet", "t"]).withColumn("us", F.unix_micros("ts")).withColumn("to", F.min("low").over(w)).select("outlet", "t", "ts", "to")
    second = titled.join(near, ["outlet", "t", "ts"]).filter("to < id").select("id", "to")
    links = second.join(first.select("id"), "id", "left_anti").unionByName(first)
    return components(links.select(F.col("to").alias("a"), F.col("id").alias("b")), a.select("id")).select("id", F.col("root").alias("original"))
