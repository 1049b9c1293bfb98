"""Texts that were cut on their way from the source.

Each source's texts are counted by length, in characters and in bytes. A field limit shows as a spike: one length at
which many texts end, nearly none of them with a sentence. At a spike, every text that does not end a sentence is cut,
dots put after the cut included. Elsewhere the end itself decides, held against the corpus: lists, credits,
headlines and closing phrases that end without a full stop come again and again in the same words, and an end that
none of them explains is a cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

#: What ends a sentence, what closes after it, and dots that may be style or stand for what was cut off.
STOP, CLOSE, DOTS = r"[.!?。！？؟।]", r"[\"'”’»」』)\]）］》〉*#■□◆●—–\-|~=_]", r"(?:\.{2,}|…+|\[(?:…|\.{3})\])"
#: A list item's number or bullet, or a label and its value.
ITEM, LABEL = r"^\s*(?:\d{1,3}[.)、]\s|[-•*–—·]\s)", r"^\s*[^\s:：.!?。]{1,20}(?: [^\s:：.!?。]{1,20}){0,2}[:：]\s?\S+(?: \S+){0,7}$"
#: Java's letters of scripts written without spaces.
DENSE = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]"
BROKEN = r"(?:\x{FFFD}|&[A-Za-z0-9#]{0,8})$"


def ends_sentence(c: Column) -> Column:
    """A full stop and what may close after it, or closing marks alone (an end sign on its own line); two or more dots are no full stop."""
    return (c.rlike(f"{STOP}{CLOSE}*\\s*$") | c.rlike(f"{STOP}{CLOSE}*\\s*(?:{CLOSE}+[\\p{{L}} ]{{0,12}}{CLOSE}+|{CLOSE}+)\\s*$") | c.rlike(r"[)）■#*」』》]\s*$")) & ~c.rlike(DOTS + CLOSE + r"*\s*$")


def _shape(docs: DataFrame, text: str) -> DataFrame:
    """What the last line and the end of a text show. Patterns of the end read the last 400 characters, where they all lie; a line's beginning and length are the whole line's, lengths the whole text's."""
    white = F.lit(" \t\n\r\x0b\x0c\u00a0\u3000")
    d = docs.withColumn("_all", F.rtrim(F.col(text), white)).filter(F.col("_all") != "")
    d = d.select(
        *[c for c in docs.columns if c != text], F.length(text).alias("_full"), F.octet_length(text).alias("_bytes"),
        (~F.col("_all").contains("\n")).alias("_one"), F.length("_all").alias("_n"), F.right("_all", F.lit(400)).alias("_t"),
        F.substring_index(F.translate("_all", "\r", "\n"), "\n", -1).alias("_line"),
    )
    d = d.withColumn("_dots", F.col("_t").rlike(DOTS + r"[\"'”’»)]*$")).withColumn("_broken", F.col("_t").rlike(BROKEN))
    d = d.withColumn("_ended", ends_sentence(F.col("_t")) & ~F.col("_broken"))
    d = d.withColumn("_inner", F.col("_t").rlike(f"{STOP}[\\s{CLOSE[1:-1]}]+\\S"))
    d = d.withColumns({"_item": F.col("_line").rlike(ITEM), "_label": F.col("_line").rlike(LABEL), "_dense": F.col("_line").rlike(DENSE), "_short": F.length("_line") < 80})
    ground = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, DOTS + r".{0,2}$", ""), r"\d+", "0"))
    # the line's own first two words; the rest of a line of many pages is not split
    head = F.split(F.trim("_line"), r"\s+", 3)
    d = d.withColumn("_w", F.split(ground(F.concat_ws(" ", F.slice(head, 1, 2))), r"\s+"))
    d = d.withColumn("_end", ground(F.substring_index(F.translate("_t", "\r", "\n"), "\n", -1)))
    d = d.withColumn("_style", F.col("_end").rlike("[”’»]$") | F.right("_line", F.lit(400)).rlike(f"{STOP}{CLOSE}*(?:…+|……)$|[”’»]$"))
    d = d.withColumn("_after", F.filter(F.split(F.element_at(F.split("_end", STOP), -1), r"\s+"), lambda x: x != ""))
    return d.select(
        "*", F.element_at("_w", 1).alias("_first"), F.element_at(F.split("_end", r"\s+"), -1).alias("_last"), F.concat_ws(" ", F.slice("_w", 1, 2)).alias("_two"),
        F.concat_ws(" ", F.slice("_after", F.greatest(F.size("_after") - 1, F.lit(1)), F.lit(2))).alias("_tail"),
    ).drop("_w", "_after", "_end", "_t", "_line")


def spikes(shaped: DataFrame, source: str, least: int = 4, times: float = 4.0, near: int = 40, open_share: float = 0.7) -> DataFrame:
    """source, unit (chars, bytes), low, high: lengths at which a source's texts end more often than ``times`` what
    lengths within ``near`` of it do on average, at least ``least`` of them, ``open_share`` of which end no sentence.

    Bytes are counted over five neighbouring lengths, since a limit in bytes cuts at, within or around a character.
    The histogram is at most lengths by sources; texts were summed into it before the shuffle.
    """
    unit = F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("_full").alias("n")), F.struct(F.lit("bytes").alias("unit"), F.col("_bytes").alias("n")))).alias("u")
    h = shaped.select(source, "_ended", unit).groupBy(source, "u.unit", "u.n").agg(F.count("*").alias("k"), F.sum((~F.col("_ended")).cast("int")).alias("open"))
    w = Window.partitionBy(source, "unit").orderBy("n")
    around, close = w.rangeBetween(-near, near), w.rangeBetween(-2, 2)
    h = h.withColumn("k5", F.sum("k").over(close)).withColumn("open5", F.sum("open").over(close)).withColumn("all", F.sum("k").over(around))
    narrow = (F.col("k") >= least) & (F.col("open") >= open_share * F.col("k")) & (F.col("k") > times * F.greatest((F.col("all") - F.col("k")) / (2.0 * near), F.lit(0.25)))
    wide = (F.col("unit") == "bytes") & (F.col("k5") >= 2 * least) & (F.col("open5") >= open_share * F.col("k5")) & (F.col("k5") > times * F.greatest((F.col("all") - F.col("k5")) * 5 / (2.0 * near - 4), F.lit(1.0)))
    return h.filter(narrow | wide).select(source, "unit", F.col("n").alias("length")).distinct()


def length_spikes(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """source, unit, length of :func:`spikes` over whole texts; a null source is an empty one."""
    slim = docs.select(F.coalesce(F.col(source), F.lit("")).alias("source"), F.col(text).alias("_text")).filter("_text is not null")
    return spikes(_shape(slim, "_text"), "source").select("source", "unit", "length")


def truncated(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", natural: float = 0.5, often: float = 0.02, seen: int = 3) -> DataFrame:
    """key, source, cut (BOOLEAN), reason of every text that is not blank; null, empty and blank texts were not cut.

    reason: ``broken`` (ends in a broken character or entity), ``limit`` (at a spike of its source, no sentence ended),
    ``dots`` (dots after an end that is no closing phrase), ``open`` (no end of a sentence, list, credit or headline).

    Closing phrases and credits are those whose words come back: the last words before dots in at least ``seen``
    texts and ``often`` of all that end in dots; first words of a last line that stay open in at least ``natural`` of
    the lines so begun, in at least ``seen`` texts; a last word that mostly stands at an open end. One line without an
    inner stop is a headline if it begins or ends in such a way, or ends in a word that sentences end with or a
    name, unless it begins as sentences do. Sources may be null and are then one source. ``docs`` may hold any other columns.
    """
    tmp = Scratch(docs.sparkSession, "truncated")
    slim = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(source), F.lit("")).alias("_source"), F.col(text).alias("_text"))
    d = tmp.keep(_shape(slim, "_text"), "ends")
    limit = spikes(d, "_source")
    d = d.join(limit.filter("unit = 'chars'").select("_source", F.col("length").alias("_full"), F.lit(True).alias("_c")), ["_source", "_full"], "left")
    d = d.join(limit.filter("unit = 'bytes'").select("_source", F.col("length").alias("_bytes"), F.lit(True).alias("_b")), ["_source", "_bytes"], "left")
    d = tmp.keep(d.withColumn("_limit", F.coalesce("_c", "_b", F.lit(False)) & ~F.col("_ended")).drop("_c", "_b"), "limits")
    open_ = ~F.col("_ended") & ~F.col("_dots") & ~F.col("_limit") & ~F.col("_broken")
    dotted = F.col("_dots") & ~F.col("_limit") & ~F.col("_broken")
    total = d.agg(F.sum(open_.cast("int")).alias("o"), F.sum(dotted.cast("int")).alias("p")).first()
    n_open, n_dots = total["o"] or 0, total["p"] or 0
    # how lines begin in the whole corpus and whether they end a sentence, for the beginnings in question
    asked = d.filter(open_).select(F.explode(F.array_distinct(F.array("_first", "_two"))).alias("head")).distinct()
    lines = slim.filter(F.col("_text").isNotNull()).select(F.explode(F.split("_text", r"[\n\r]+")).alias("line"))
    lines = lines.select(F.rtrim("line").alias("end"), F.split(F.trim("line"), r"\s+", 3).alias("w"))
    heads = lines.select("end", F.explode(F.array_distinct(F.transform(F.array(F.element_at("w", 1), F.concat_ws(" ", F.slice("w", 1, 2))), lambda x: F.regexp_replace(x, r"\d+", "0")))).alias("head"))
    heads = heads.join(asked, "head", "left_semi").groupBy("head").agg(F.count("*").alias("n"), F.sum((~ends_sentence(F.col("end"))).cast("int")).alias("open"))
    begins = F.when((F.col("open") >= seen) & (F.col("open") >= natural * F.col("n")), 1).when((F.col("n") >= 10 * seen) & (F.col("open") < 0.25 * F.col("n")), -1)
    heads = tmp.keep(heads.select("head", begins.alias("_k")).filter("_k is not null"), "heads")
    tails = d.filter(dotted).groupBy("_tail").agg(F.count("*").alias("n")).filter(F.col("n") >= max(seen, often * n_dots)).select("_tail", F.lit(True).alias("_kt"))
    # how often the last words in question are written, with a stop after them, and left at an open end
    lasts = d.filter(open_ & ~F.col("_last").rlike(DENSE)).groupBy("_last").agg(F.count("*").alias("left"))
    words = slim.filter(F.col("_text").isNotNull()).select(F.explode(F.split("_text", r"[\s“”\"()]+")).alias("x"))
    words = words.select(F.rtrim("x", F.lit(".,;:!?。！？")).alias("_last"), F.col("x").rlike(r"[.!?。！？;,]$").alias("stop"))
    # counted in each task first, so that what is shuffled is the words there are, not the words written
    lasts = words.groupBy("_last").agg(F.count("*").alias("n"), F.sum(F.col("stop").cast("int")).alias("stops")).join(lasts, "_last")
    lasts = lasts.select(
        "_last", (F.col("stops") >= F.greatest(F.lit(1.0), 0.02 * F.col("n"))).alias("_final"),
        ((F.col("left") >= max(seen, often * n_open / 10)) & (F.col("left") >= natural * F.col("n"))).alias("_kl"),
    )
    d = d.join(heads.withColumnRenamed("head", "_first").withColumnRenamed("_k", "_k1"), "_first", "left").join(heads.withColumnRenamed("head", "_two").withColumnRenamed("_k", "_k2"), "_two", "left")
    d = d.join(lasts, "_last", "left").join(tails, "_tail", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    known = (F.coalesce("_k1", F.lit(0)) > 0) | (F.coalesce("_k2", F.lit(0)) > 0) | yes("_kl")
    opener = (F.coalesce("_k1", F.lit(0)) < 0) | (F.coalesce("_k2", F.lit(0)) < 0)
    credit = F.col("_item") | known | F.col("_label")
    name_end = F.col("_last").rlike(r"^\p{Lu}") & F.col("_short")
    headline = F.col("_one") & ~F.col("_inner") & (F.col("_n") < 200) & ~F.col("_dense") & (known | (~opener & (yes("_final") | name_end)))
    # dots after the mark that ended a sentence, or inside a closing quotation, are style
    style = yes("_kt") | F.col("_style")
    reason = (
        F.when(F.col("_broken"), "broken").when(F.col("_limit"), "limit").when(F.col("_dots"), F.when(~style, "dots"))
        .when(~F.col("_ended"), F.when(F.when(F.col("_one"), ~headline).otherwise(~credit), "open"))
    )
    return d.select(F.col("_key").alias(key), F.nullif("_source", F.lit("")).alias(source), reason.isNotNull().alias("cut"), reason.alias("reason"))


def shares(found: DataFrame, source: str = "source") -> DataFrame:
    """source, texts, cut, share: how often each source's texts are cut."""
    return found.groupBy(source).agg(F.count("*").alias("texts"), F.sum(F.col("cut").cast("int")).alias("cut")).withColumn("share", F.col("cut") / F.col("texts"))
