"""Names and facts found in dated text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import WORDLIKE, collapse, fold

#: Least letters of a name that is looked for anywhere in a text.
HEAD = 7
IDEOGRAPH = r"[\x{3400}-\x{9FFF}]"
# Fixed value: an age as a text writes it.
AGE = r"(?:aged|age of|\()\s*([0-9]{2})\b|\b([0-9]{2})[- ]year[- ]old|([0-9]{2})岁"
DEATH_YEARS, AGE_GAP, NAME_SPAN, AGES = 1, 2, 45, (15, 105)


def norm(c: Column) -> Column:
    """Lower case, punctuation as space, white space run together."""
    return collapse(F.regexp_replace(fold(c), f"[^{WORDLIKE}]+", " "))


def fact_norm(c: Column) -> Column:
    """A fact's key: brackets without a number first dropped, punctuation as space, a leading country name dropped, plural words singular."""
    t = F.regexp_replace(fold(c), r"\([^0-9)][^)]*\)|\(\)", " ")
    t = F.regexp_replace(norm(t), r"^singapore (?=.)", "")
    one = lambda w: F.when((F.length(w) > 3) & w.endswith("s") & ~w.endswith("ss"), F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w)
    return F.array_join(F.transform(F.split(t, " "), one), " ")


def forms(name: Column) -> Column:
    """The forms of a name an article would print, normalised: ``last, first`` both ways round, else the name and the name without its country; of ideographs three or more, of letters two words or one of eight."""
    bare = collapse(F.regexp_replace(name, r"\([^)]*\)", " "))
    cut = F.split(bare, ",")
    turned = (F.size(cut) == 2) & ~bare.rlike(IDEOGRAPH)
    a, b = F.trim(cut[0]), F.trim(F.get(cut, F.lit(1)))
    each = F.when(turned, F.array(F.concat(a, F.lit(" "), b), F.concat(b, F.lit(" "), a))).otherwise(F.array(bare, F.regexp_replace(bare, r"^Singapore\. ", "")))

    def usable(f: Column) -> Column:
        words = F.split(f, " ")
        latin = f.rlike("[a-z]") & (((F.size(words) >= 2) & F.exists(words, lambda w: F.length(w) > 1)) | ((F.size(words) == 1) & (F.length(f) >= 8)))
        dense = F.replace(f, F.lit(" "), F.lit(""))
        return F.when(f.rlike(IDEOGRAPH), F.when(F.length(dense) >= 3, dense)).otherwise(F.when(latin, f))

    return F.array_distinct(F.array_compact(F.transform(F.transform(each, norm), usable)))


def first_printed(names: DataFrame, articles: DataFrame) -> DataFrame:
    """key, day, id of the first article in [start, stop) that prints a form of each name; names not printed give no row.

    ``names``: key, name, start, stop (DATE); ``articles``: id, day, text. A form of words is looked up by its rarest word, counted over the articles' different words, and then as a whole; a form of
    ideographs by its first three characters. So an article's text meets only the forms whose rarest part it holds.
    """
    a = articles.filter("day is not null").select("id", "day", norm(F.col("text")).alias("t"))
    f = names.select("key", "start", "stop", F.explode(forms(F.col("name"))).alias("form")).distinct()
    words = a.select("id", F.explode(F.array_distinct(F.split("t", " "))).alias("w")).filter(F.col("w").rlike("[a-z]"))
    seen = words.groupBy("w").agg(F.count("*").alias("df"))
    latin = f.filter(~F.col("form").rlike(IDEOGRAPH)).withColumn("w", F.explode(F.array_distinct(F.split("form", " "))))
    # a form with a word that no article has is printed nowhere
    probe = latin.join(seen, "w", "left").groupBy("key", "start", "stop", "form").agg(F.min_by("w", F.struct("df", "w")).alias("w"), F.count(F.when(F.col("df").isNull(), 1)).alias("lost")).filter("lost = 0")
    hit = probe.join(words, "w").join(a, "id").filter((F.col("day") >= F.col("start")) & (F.col("day") < F.col("stop")) & F.concat(F.lit(" "), "t", F.lit(" ")).contains(F.concat(F.lit(" "), F.col("form"), F.lit(" "))))
    dense = f.filter(F.col("form").rlike(IDEOGRAPH)).withColumn("head", F.substring("form", 1, 3))
    runs = a.filter(F.col("t").rlike(IDEOGRAPH)).select("id", "day", "t", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("t") - 2, F.lit(1))), lambda i: F.substring(F.col("t"), i, F.lit(3))))).alias("head"))
    hit2 = dense.join(runs, "head").filter((F.col("day") >= F.col("start")) & (F.col("day") < F.col("stop")) & F.col("t").contains(F.col("form")))
    return hit.select("key", "day", "id").unionByName(hit2.select("key", "day", "id")).groupBy("key").agg(F.min(F.struct("day", "id")).alias("m")).select("key", "m.day", "m.id")


def names_any(texts: DataFrame, names: DataFrame, least: int = HEAD) -> DataFrame:
    """id of the texts (id, text) that hold any of the names (name) of ``least`` characters or more, case aside: a text's runs of that length meet the names' first letters, and what meets is looked at whole."""
    n = names.filter(F.length("name") >= least).select(F.lower("name").alias("name")).distinct().withColumn("head", F.substring("name", 1, least))
    t = texts.filter(F.length("text") >= least).select("id", F.lower("text").alias("t"))
    heads = n.select("head").distinct()
    runs = t.select("id", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("t") - least + 1), lambda i: F.substring(F.col("t"), i, F.lit(least))))).alias("head"))
    met = runs.join(heads, "head", "left_semi")
    return met.join(n, "head").join(t, "id").filter(F.col("t").contains(F.col("name"))).select("id").distinct()


def sentences_with(text: Column, form: Column) -> Column:
    """The first two sentences of a text that hold a form, in Latin or ideographic script."""
    parts = F.filter(F.transform(F.split(F.regexp_replace(text, r"([.!?])\s+|([。！？])", "$1$2\u0001"), "\u0001"), lambda s: F.trim(s)), lambda s: s != "")
    return F.slice(F.filter(parts, lambda s: s.contains(form)), 1, 2)


def ages_near(text: Column, name: Column) -> Column:
    """Ages written within ``NAME_SPAN`` characters after the last place a text has a name (case aside)."""
    return F.transform(F.filter(F.regexp_extract_all(F.call_function("substring_index", F.lower(text), F.lower(name), F.lit(-1)), F.lit("(?s)^.{0,%d}?(?:%s)" % (NAME_SPAN, AGE)), F.lit(0)), lambda x: x != ""), lambda x: F.regexp_extract(x, r"([0-9]{2})[^0-9]*$", 1).cast("int"))


def vetoed(kind: Column, fields: Column, ages: Column, year: Column) -> Column:
    """Why a record cannot be meant: ``died`` before the article's last year, or a birth year that an age printed beside the name contradicts; null otherwise."""
    at = lambda k: F.regexp_extract(F.coalesce(F.try_element_at(fields, F.lit(k)), F.lit("")), "([0-9]{4})", 1).try_cast("int")
    died, born = at("Death Year (yyyy)"), at("Birth Year (yyyy)")
    wrong = F.exists(ages, lambda a: a.between(*AGES) & (F.abs(year - a - born) > AGE_GAP))
    return F.when(died < year - DEATH_YEARS, "died").when((kind == "PERSON") & F.coalesce(wrong, F.lit(False)), "age")


def facts_backed(facts: DataFrame, held: DataFrame) -> DataFrame:
    """Facts (uid, field, value, day) an article gave that the record lacked in the last snapshot before and has in the next one after: uid, field, value, snapshot.

    ``held``: uid, field, value, snapshot, previous (the snapshot before, null on the first). The article's day lies in [previous, snapshot); values are held against each other by :func:`fact_norm`.
    """
    h = held.withColumn("k", fact_norm(F.col("value"))).filter("k <> ''")
    f = facts.withColumn("k", fact_norm(F.col("value"))).filter("k <> ''").distinct()
    got = f.join(h.select("uid", "field", "k", "snapshot", "previous").distinct(), ["uid", "field", "k"]).filter((F.col("day") >= F.col("previous")) & (F.col("day") < F.col("snapshot")))
    before = h.select("uid", "field", "k", F.col("snapshot").alias("previous")).distinct()
    there = h.select("uid", F.col("snapshot").alias("previous")).distinct()
    return got.join(before, ["uid", "field", "k", "previous"], "left_anti").join(there, ["uid", "previous"], "left_semi").select("uid", "field", "value", "snapshot").distinct()
