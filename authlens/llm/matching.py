"""Matching records of two sources that share no key.

Sorted neighbourhood: both sides are sorted by several composite keys, each mention is compared with the records
that stand next to it, fields are weighed by kind, and of the matches of one article each record goes to one
written name so that the total confidence is as large as can be.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.hierarchy import canonical_edges, hierarchy
from ..scratch import Scratch
from .common import spread
from .names import DENSE, near, parts, similarity, written

# What readers call the authority's fields.
FIELD = {
    "name": "", "occupation": "job", "job": "job", "title": "job", "birth year": "born", "born": "born", "birth year yyyy": "born", "age": "age",
    "affiliation": "org", "affiliations": "org", "affiliations groupname": "org", "nationality": "nation", "country": "nation",
    "year started": "year", "year started yyyy": "year", "founded": "year", "year completed": "year", "year completed yyyy": "year", "opened": "year",
    "year": "year", "year first awarded": "year", "postal code": "post", "postcode": "post", "address": "street", "street address": "street",
    "organiser": "host", "organised by": "host", "run by": "host", "awarding entity": "host", "description": "text",
}
#: What a field that agrees adds to the name's similarity, and what one that does not takes off.
GAIN = {"born": (0.16, 0.22), "job": (0.07, 0.10), "org": (0.16, 0.05), "nation": (0.03, 0.10), "year": (0.12, 0.16), "post": (0.18, 0.15), "street": (0.18, 0.12), "host": (0.14, 0.14)}
COMMON_SHARE = 0.0005
#: Words of a description's beginning that may be another name of the occupation.
LEAD = 4
#: The step of a bid: the assignment's total is at most this a written name below the largest there is.
BID = 0.01


def facts(fields, year: int | None = None) -> dict[str, str]:
    """Fields by kind. An age becomes the year of birth it means in ``year``, marked with ``~``."""
    out: dict[str, str] = {}
    for f in fields if fields is not None else ():
        k, v = f["key"], f["value"]
        kind = FIELD.get(" ".join(re.sub(r"[^a-z]+", " ", k.lower()).split()))
        if not kind or not v or not v.strip():
            continue
        if kind in ("born", "year"):
            y = re.search(r"(1[6-9]|20)\d\d", v)
            if y:
                out[kind] = y.group()
        elif kind == "age":
            n = re.search(r"\d+", v)
            if n and year and "born" not in out:
                out.setdefault("age", str(year - int(n.group())))
        elif kind == "post":
            out[kind] = "".join(re.findall(r"\d", v)) or v.strip().lower()
        else:
            out[kind] = f"{out[kind]} | {v}" if kind in out else v
    if "age" in out:
        age = out.pop("age")
        out.setdefault("born", "~" + age)
    return out


def _lists(a: str, b: str) -> float:
    """The best likeness of any two values of two lists."""
    best = 0.0
    for x in a.split(" | "):
        for y in b.split(" | "):
            p, q = parts(x), parts(y)
            best = max(best, similarity(p, q, len, 0.8, 0.5))
            if best > 0.99:
                return best
    return best


def agreement(a: dict[str, str], b: dict[str, str], jobs: dict[str, str] | None = None) -> tuple[float, int, int]:
    """What fields both sides have add or take, and how many agree and disagree. ``jobs``: other words for an occupation."""
    score, yes, no = 0.0, 0, 0
    for kind, v in a.items():
        w = b.get(kind)
        if kind == "text" or (w is None and kind != "job"):
            continue
        up, down = GAIN[kind]
        if kind in ("born", "year"):
            gap = abs(int(v.lstrip("~")) - int(w.lstrip("~")))
            same = 1.0 if gap <= (1 if "~" in v + w else 0) else 0.0 if gap > 1 else 0.5
        elif kind == "post":
            same = 1.0 if v == w else 0.5 if near(v, w) else 0.0
        elif kind == "job":
            text = b.get("text", "").lower()
            x = v.lower().strip()
            x = (jobs or {}).get(x, x)
            if w is None and not text:
                continue
            known = [y.strip() for y in (w or "").lower().split("|") if y.strip()]
            lead = text.split()[:LEAD]
            said = next((jobs[h] for i in range(len(lead), 0, -1) if (h := " ".join(lead[:i])) in jobs), None) if jobs else None
            same = 1.0 if any(x == y or x in y or y in x or near(x, y) for y in [*known, *([said] if said else [])]) or (x and text.startswith(x)) else 0.0 if known or said else 0.5
        else:
            s = _lists(v, w)
            same = 1.0 if s >= 0.8 else 0.5 if s >= 0.6 else 0.0
        if same >= 0.7:
            score, yes = score + up * same, yes + 1
        elif same == 0.0:
            score, no = score - down, no + 1
    return score, yes, no


def most_added(a: dict[str, str], b: dict[str, str]) -> float:
    """The most that :func:`agreement` may add."""
    return sum(GAIN[k][0] for k in a if k != "text" and (k in b or (k == "job" and "text" in b)))


def sort_keys(kind: str, name: str, given: dict[str, str]) -> list[str]:
    """Composite keys of one written name: words in order of size, reversed, without vowels, each word with the others' initials, and facts with initials."""
    p = parts(name)
    if not p:
        return []
    k = (kind or "?")[:3]
    joined = "".join(sorted(p))
    keys = [f"{k}1{' '.join(sorted(p, key=lambda w: (-len(w), w)))}", f"{k}2{''.join(p)[::-1]}", f"{k}3{''.join(p)}"]
    if not DENSE.search(joined):
        keys.append(f"{k}4{' '.join(sorted((w[0] + re.sub('[aeiou]', '', w[1:]) for w in p if len(w) > 1), key=lambda w: (-len(w), w)))}")
        for w in sorted({w for w in p if len(w) > 2}):
            keys.append(f"{k}5{w} {''.join(sorted(x[0] for x in p if x != w))}")
    first = min(p)[0]
    for kind_, v in given.items():
        if kind_ in ("post", "street"):
            keys.append(f"{k}6{''.join(v.lower().split())} {first}")
        elif kind_ == "born":
            keys.append(f"{k}7{v.lstrip('~')} {''.join(sorted(x[0] for x in p))} {max(p, key=len)}")
    return keys


def _bits(words: tuple[str, ...]) -> tuple[int, int]:
    """128 bits, one for each pair of neighbouring letters of a name's words; a letter that begins a word counts as a pair."""
    out = [0, 0]
    for w in words:
        for g in ("^" + w[0], *(w[i : i + 2] for i in range(len(w) - 1))):
            h = xxhash.xxh64_intdigest(g)
            out[h & 1] |= 1 << ((h >> 1) & 63)
    return tuple(x - (1 << 64) if x >> 63 else x for x in out)


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a written name: its words, their bits and initials, its sort keys, and the record's facts as JSON."""
    for b in batches:
        rows = []
        for side, rid, kind, names, fields, year in b[["side", "rid", "kind", "names", "fields", "year"]].itertuples(index=False, name=None):
            given = facts(fields, None if pd.isna(year) else int(year))
            told = json.dumps(given, ensure_ascii=False)
            seen: set[str] = set()  # a record stands once at a key, whatever the number of its names
            for place, name in enumerate(written(names)):
                words = parts(name)
                if not words:
                    continue
                keys = [k for k in sort_keys(kind, name, given) if k not in seen]
                seen.update(keys)
                one, two = _bits(words)
                rows.append((side, rid, place, kind, " ".join(words), one, two, "".join(w[0] for w in words), told, keys))
        yield pd.DataFrame(rows, columns=["side", "rid", "n", "kind", "words", "b1", "b2", "initials", "facts", "keys"])


FEATURES = "side int, rid long, n int, kind string, words string, b1 long, b2 long, initials string, facts string, keys array<string>"


def _number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Numbers the records of one sorted part; a mention gets the number of the last record before it."""
    from pyspark import TaskContext

    part, at = TaskContext.get().partitionId(), 0
    for b in batches:
        at_here = at + (b.side == 1).cumsum().to_numpy()
        at = int(at_here[-1]) if len(b) else at
        yield b.assign(part=part, place=at_here)[["side", "rid", "n", "equal", "part", "place"]]


def neighbours(rows: DataFrame, tmp: Scratch, width: int = 5, parts_: int | None = None) -> DataFrame:
    """Different pairs (mention, record, n: which of the record's names) of one key, whatever their number, or within ``width`` records before and after those of the mention's key.

    ``rows``: side (0 mention, 1 record), rid LONG, n, key. Rows are range-partitioned and sorted by key, records are numbered in that order
    over all parts (the number of records of each part is the only thing the driver holds), and each mention is joined with the numbers around its place; windows so run over part limits.
    A mention stands before the records of its key, so its window reaches over as many as there are and ``width`` more; numbers spread the join, a crowded key's too.
    """
    spark = rows.sparkSession
    n = parts_ or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    equal = rows.filter("side = 1").groupBy("key").agg(F.count("*").alias("equal"))
    rows = rows.join(equal, "key", "left").withColumn("equal", F.coalesce("equal", F.lit(0)))
    ordered = rows.repartitionByRange(n, "key", "side", "rid").sortWithinPartitions("key", "side", "rid")
    placed = tmp.keep(ordered.mapInPandas(_number, "side int, rid long, n int, equal long, part int, place long"), "placed")
    sizes = sorted((r["part"], r["n"]) for r in placed.filter("side = 1").groupBy("part").agg(F.count("*").alias("n")).collect())
    had = dict(sizes)
    offsets, before = [], 0
    for part in range(n):
        offsets.append((part, before))
        before += had.get(part, 0)
    offset = F.broadcast(spark.createDataFrame(offsets, "part int, _before long"))
    placed = placed.join(offset, "part").withColumn("place", F.col("place") + F.col("_before"))
    records = placed.filter("side = 1").select("place", F.col("rid").alias("record"), "n")
    mentions = placed.filter("side = 0").select(F.col("rid").alias("mention"), F.explode(F.sequence(F.col("place") - width + 1, F.col("place") + F.col("equal") + width)).alias("place"))
    return mentions.join(records, "place").select("mention", "record", "n").distinct()


def match(mentions: DataFrame, records: DataFrame, width: int = 5, floor: float = 0.76, near_name: float = 0.5, margin: float = 0.03) -> DataFrame:
    """extracted_id, uid, confidence: the record each mention means, if any.

    ``mentions``: id, article_id, entity_name, entity_name_en, entity_type, fields MAP, created_at. ``records``: uid, name, entity_type,
    canonical_uid, fields MAP, is_active. A thing's names are those of all its active rows; its fields are all rows' together; its uid is
    the end of the canonical chain (the smallest uid on a ring). Null or blank names match nothing, null fields are no fields; repeated mentions are matched once and each gets the
    result; further columns are ignored. ``floor``: least confidence; ``near_name``: least likeness of names; of things whose scores
    lie within ``margin`` the one with more agreeing fields is taken, then the smaller uid.
    """
    spark = mentions.sparkSession
    tmp = Scratch(spark, "match")
    top = hierarchy(canonical_edges(records), paths=False).select(F.col("node").alias("uid"), "root")
    live = records.filter("is_active").select("uid", "name", "entity_type", "fields").join(top, "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    own = F.sort_array(F.map_entries(F.coalesce("fields", F.create_map().cast("map<string,string>"))))
    things = tmp.keep(
        live.groupBy("root").agg(
            F.min_by("entity_type", F.struct(F.col("uid") != F.col("root"), "uid")).alias("kind"),
            F.collect_set(F.when(F.trim("name") != "", F.col("name"))).alias("names"),
            F.array_distinct(F.flatten(F.collect_list(own))).alias("fields"),
        ).withColumn("rid", F.xxhash64("root")),
        "things",
    )
    # mentions that say the same are one; 64 bits tell them apart: at a thousand million different mentions the odds of any two meeting are a few in a hundred
    m = mentions.select(
        "id", F.coalesce("article_id", -F.col("id")).alias("article_id"), F.col("entity_type").alias("kind"), F.year("created_at").cast("int").alias("year"),
        F.array_distinct(F.filter(F.array("entity_name", "entity_name_en"), lambda x: F.trim(x) != "")).alias("names"), own.alias("fields"),
    ).filter("size(names) > 0")
    m = tmp.keep(m.withColumn("rid", F.xxhash64(F.to_json(F.struct("kind", "year", "names", "fields")))), "mentions")
    shape = "array<struct<key: string, value: string>>"
    said = m.groupBy("rid").agg(F.first("kind").alias("kind"), F.first("year").alias("year"), F.first("names").alias("names"), F.first("fields").alias("fields"))
    both = said.select(F.lit(0).alias("side"), "rid", "kind", "names", F.col("fields").cast(shape), "year").unionByName(
        things.select(F.lit(1).alias("side"), "rid", "kind", "names", F.col("fields").cast(shape), F.lit(None).cast("int").alias("year"))
    )
    features = tmp.keep(spread(both).mapInPandas(_features, FEATURES), "features")
    pairs = tmp.keep(neighbours(features.select("side", "rid", "n", F.explode("keys").alias("key")), tmp, width), "met")
    tmp.release()
    # words of more than a two-thousandth of all names weigh less; there are few of them whatever the number of names
    total = max(features.count(), 1)
    often = features.select(F.explode(F.split("words", " ")).alias("w")).groupBy("w").agg(F.count("*").alias("n")).filter(F.col("n") >= max(COMMON_SHARE * total, 2)).collect()
    common = spark.sparkContext.broadcast({r["w"]: r["n"] / total for r in often})
    jobs = spark.sparkContext.broadcast(_occupations(live))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        most = -math.log(COMMON_SHARE)
        weights = {w: min(most, -math.log(x)) for w, x in common.value.items()}
        weight = lambda w: weights.get(w, most)
        told = lru_cache(20_000)(json.loads)
        for b in batches:
            rows = []
            for mention, record, left, right, mf, rf in b[["mention", "record", "mwords", "rwords", "mf", "rf"]].itertuples(index=False, name=None):
                like = similarity(tuple(left.split(" ")), tuple(right.split(" ")), weight)
                if like < near_name:
                    continue
                said, held = told(mf), told(rf)
                if like + most_added(said, held) < floor - 1e-9:
                    continue
                add, yes, _ = agreement(said, held, jobs.value)
                if like + add >= floor:
                    rows.append((mention, record, like + add, yes))
            yield pd.DataFrame(rows, columns=["rid", "record", "score", "agree"])

    # pairs of names that cannot be half alike are told by their letter pairs, in the JVM: both names' bits ride along, words and facts are fetched for the rest
    side = lambda k, p: features.filter(F.col("side") == k).select(F.col("rid").alias("mention" if k == 0 else "record"), *([F.col("n").alias("mn")] if k == 0 else ["n"]), *[F.col(c).alias(f"{p}{c}") for c in ("kind", "b1", "b2", "initials")])
    near_ = pairs.join(side(0, "m"), "mention").join(side(1, "r"), ["record", "n"]).filter(F.col("mkind").isNull() | F.col("rkind").isNull() | (F.col("mkind") == F.col("rkind")))
    bits = lambda f: F.bit_count(f("b1")) + F.bit_count(f("b2"))
    shared = bits(lambda c: F.col(f"m{c}").bitwiseAND(F.col(f"r{c}")))
    fewer = F.least(bits(lambda c: F.col(f"m{c}")), bits(lambda c: F.col(f"r{c}")))
    # an acronym shares few letter pairs with what it stands for
    spelt = F.col("rinitials").startswith(F.left("minitials", F.lit(1))) & (F.length("rinitials") > 2) & (F.length("minitials") < 3)
    near_ = near_.filter((shared >= 0.5 * fewer) | spelt).select("mention", "record", "mn", "n")
    text = lambda k, p: features.filter(F.col("side") == k).select(F.col("rid").alias("mention" if k == 0 else "record"), *([F.col("n").alias("mn")] if k == 0 else ["n"]), F.col("words").alias(f"{p}words"), F.col("facts").alias(f"{p}f"))
    near_ = tmp.keep(near_, "pairs")
    tmp.release()
    full = near_.join(text(0, "m"), ["mention", "mn"]).join(text(1, "r"), ["record", "n"])
    scored = full.mapInPandas(score, "rid long, record long, score double, agree int").groupBy("rid", "record").agg(F.max("score").alias("score"), F.max("agree").alias("agree"))
    scored = tmp.keep(scored.join(things.select(F.col("rid").alias("record"), F.col("root").alias("uid")), "record").select("rid", "uid", "score", "agree"), "scored")
    for done in ("placed", "met", "pairs", "features"):
        tmp.drop(done)
    return assign(m, scored, tmp, floor, margin)


def _occupations(live: DataFrame) -> dict[str, str]:
    """What descriptions call an occupation: the longest beginning that stands with one occupation in most of its uses. Beginnings of fewer than one record in two thousand are no usage, so there are few."""
    told = live.select(F.lower(F.trim(F.col("fields")["Occupation"])).alias("job"), F.slice(F.split(F.lower(F.trim(F.col("fields")["Description"])), r"\s+"), 1, LEAD).alias("w")).filter("job <> '' and size(w) > 0 and w[0] <> ''")
    heads = told.select("job", F.explode(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.array_join(F.slice("w", F.lit(1), i), " "))).alias("head"))
    uses = heads.groupBy("head", "job").agg(F.count("*").alias("n"))
    best = uses.groupBy("head").agg(F.sum("n").alias("all"), F.max(F.struct("n", "job")).alias("m"))
    found = best.filter((F.col("all") >= max(COMMON_SHARE * told.count(), 2)) & (F.col("m.n") >= 0.6 * F.col("all"))).select("head", "m.job").collect()
    return {r["head"]: r["job"] for r in found}


def assign(mentions: DataFrame, scored: DataFrame, tmp: Scratch, floor: float, margin: float, bid: float = BID) -> DataFrame:
    """Of each article, every written name gets one thing and every thing one written name, so that the total confidence is the largest there is, less at most ``bid`` a name.

    Written names that are one name (the same words in any order) and mentions repeated under other ids go together. What a pair is worth is its
    score above ``floor`` in steps of ``margin``, then agreeing fields, then the score itself. Things are auctioned: every name without a thing bids for the one
    worth most to it at the present prices, as much as makes it worth ``bid`` less than the next best (or none); the highest bid takes the thing, whoever held it bids again. A
    name to which nothing is worth its price gets none. Each turn reads only the pairs of names that bid, and no group of an article is held in one place. Of equal bids the smaller name's wins.
    """
    words_of = F.pandas_udf(lambda s: pd.Series([" ".join(sorted(parts(x[0]))) for x in s]), "string")
    ids = tmp.keep(mentions.select("id", "rid", "article_id", words_of("names").alias("said")), "said")
    worth = F.round((F.col("score") - floor) / margin) * margin + F.least("agree", F.lit(9)) * (margin / 10) + F.col("score") * (margin / 100) + bid
    e = scored.join(ids.select("rid", "article_id", "said").distinct(), "rid").groupBy("article_id", "said", "uid").agg(F.max(worth).alias("worth"), F.max("score").alias("score"))
    e = tmp.keep(e.withColumn("name", F.xxhash64("article_id", "said")).withColumn("thing", F.xxhash64("article_id", "uid")), "edges")
    slim = e.select("name", "thing", "worth")
    held = e.select("thing", F.lit(0.0).alias("price"), "name").filter(F.lit(False))
    waiting, turn = None, 0
    while True:
        turn += 1
        open_ = slim if waiting is None else slim.join(waiting, "name", "left_semi")
        value = F.col("worth") - F.coalesce("price", F.lit(0.0))
        now = open_.join(held.select("thing", "price"), "thing", "left").withColumn("value", value).filter("value > 0")
        order = Window.partitionBy("name").orderBy(F.col("value").desc(), "thing")
        two = now.withColumn("_n", F.row_number().over(order)).filter("_n <= 2")
        first, second = F.when(F.col("_n") == 1, F.struct("thing", "worth")), F.max(F.when(F.col("_n") == 2, F.col("value")))
        bids = two.groupBy("name").agg(F.max(first).alias("m"), F.coalesce(second, F.lit(0.0)).alias("v2"))
        bids = tmp.keep(bids.select("name", "m.thing", (F.col("m.worth") - F.col("v2") + bid).alias("price")), f"bids{turn}")
        if bids.isEmpty():
            break
        won = bids.groupBy("thing").agg(F.max("price").alias("price"), F.max_by("name", F.struct("price", -F.col("name"))).alias("name"))
        lost = bids.select("name").join(won.select("name"), "name", "left_anti").unionByName(held.join(won.select("thing"), "thing", "left_semi").select("name"))
        waiting = tmp.keep(lost, f"lost{turn}")
        held = tmp.keep(held.join(won.select("thing"), "thing", "left_anti").unionByName(won), f"held{turn}")
        for old in (f"bids{turn}", f"lost{turn - 1}", f"held{turn - 1}"):
            tmp.drop(old)
    taken = e.join(held.select("thing", "name"), ["thing", "name"]).select("article_id", "said", "uid", "score")
    return ids.join(taken, ["article_id", "said"]).select(F.col("id").alias("extracted_id"), "uid", F.least(F.col("score"), F.lit(1.0)).alias("confidence"))


__all__ = ["agreement", "assign", "facts", "match", "neighbours", "sort_keys"]
