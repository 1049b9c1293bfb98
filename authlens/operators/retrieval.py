"""Trigram retrieval of records by name, and ranking by shared facts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import loose_values
from ..functions.text import grams
from ..scratch import Scratch


#: Bits of a name's signature, in words of 64.
WORDS = 4
#: Rows of one gram that one task joins on the other side.
BLOCK = 5000


def _sets(names: DataFrame, name: str) -> DataFrame:
    """id, kind, name, g: different names with their grams as numbers, of which kind is a part, so that kinds never meet."""
    x = names.select("kind", F.col("name").alias(name)).filter(f"{name} is not null and kind is not null").distinct()
    return x.withColumn("g", F.transform(grams(F.col(name)), lambda t: F.xxhash64(F.col("kind"), t))).filter("size(g) > 0").withColumn("id", F.xxhash64("kind", name))


def _heads(sets: DataFrame, df: DataFrame, floor: float) -> DataFrame:
    """The grams of each name, rarest first, up to the last at which a pair of at least ``floor`` can first meet: id, gram, n (grams in all), left (grams from here on), signature."""
    e = sets.select("id", F.explode("g").alias("gram")).join(df, "gram")
    bits = [F.bit_or(F.when(F.pmod("gram", F.lit(WORDS)) == i, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.floor(F.col("gram") / WORDS), F.lit(64)).cast("int"))).otherwise(F.lit(0).cast("long"))).alias(f"s{i}") for i in range(WORDS)]
    x = e.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("g"), *bits)
    n = F.size("g")
    x = x.select("id", n.alias("n"), *[f"s{i}" for i in range(WORDS)], F.posexplode(F.slice("g", F.lit(1), n - F.ceil(F.lit(floor) * n).cast("int") + 1)).alias("at", "x"))
    return x.select("id", "n", (F.col("n") - F.col("at")).alias("left"), *[f"s{i}" for i in range(WORDS)], "x.gram", "x.df")


def trigram_pairs(left: DataFrame, right: DataFrame, floor: float = 0.3, tmp: Scratch | None = None) -> DataFrame:
    """kind, lname, rname, similarity of names (columns kind, name) of one kind whose shared share of grams is at least ``floor``.

    Names of equal text are one on each side. The grams of a name are sorted by rarity; two names that share ``floor`` of their
    grams must share one among the rarest of each, so only as many are joined as that takes. The join carries numbers alone: what both have left from the
    gram at which they meet, and 256 bits that tell which grams one lacks, bound what they can share; only pairs that pass fetch their grams. Grams of
    very many names are joined in parts. Names without a gram match nothing, nor do null names and kinds.
    """
    tmp = tmp or Scratch(left.sparkSession, "trigrams")
    a, b = tmp.keep(_sets(left, "lname"), f"l{floor}"), tmp.keep(_sets(right, "rname"), f"r{floor}")
    df = a.select(F.explode("g").alias("gram")).unionAll(b.select(F.explode("g").alias("gram"))).groupBy("gram").agg(F.count("*").alias("df"))
    parts = F.ceil(F.col("df") / BLOCK).cast("int")
    x = _heads(a, df, floor).withColumn("_p", F.pmod("id", parts).cast("int")).alias("x")
    y = _heads(b, df, floor).withColumn("_p", F.explode(F.sequence(F.lit(0), parts - 1))).alias("y")
    need = F.ceil(F.lit(floor / (1 + floor)) * (F.col("x.n") + F.col("y.n")) - 1e-9)
    lacks = lambda p, q: sum(F.bit_count(F.col(f"{p}.s{i}").bitwiseAND(F.bitwise_not(F.col(f"{q}.s{i}")))) for i in range(WORDS))
    met = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x._p") == F.col("y._p")) & (F.least("x.left", "y.left") >= need) & (F.col("x.n") - lacks("x", "y") >= need) & (F.col("y.n") - lacks("y", "x") >= need))
    met = met.groupBy(F.col("x.id").alias("l"), F.col("y.id").alias("r")).agg(F.lit(1).alias("_"))
    full = met.join(a.select(F.col("id").alias("l"), "kind", "lname", F.col("g").alias("lg")), "l").join(b.select(F.col("id").alias("r"), "rname", F.col("g").alias("rg")), "r")
    shared = F.size(F.array_intersect("lg", "rg"))
    sim = F.round(shared / (F.size("lg") + F.size("rg") - shared), 6)
    return full.select("kind", "lname", "rname", sim.alias("similarity")).filter(F.col("similarity") >= floor)


#: Names of records that one task holds at once, names asked that it answers at least, and the most shares that the names asked of one kind are dealt into.
HELD, ASKED, SHARES = 200_000, 10_000, 16
#: A gram of more than one record in so many is kept as a row over all records, which is quicker to add than a list.
DENSE = 32
#: Where less than one name in so many is left, those are looked at one by one.
FEW = 16
NONE = (np.empty(0, np.int64), np.empty(0, np.int64))


class Held:
    """Names of records with their grams, searched one name at a time: grams shared with every record are counted, so nothing but the best leaves a task."""

    def __init__(self, names: pa.Array, grams: pa.Array) -> None:
        self.names, self.sizes = names, pc.list_value_length(grams).to_numpy(zero_copy_only=False).astype(np.int64)
        self.vocabulary, g = np.unique(grams.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        self.df = df = np.bincount(g, minlength=len(self.vocabulary))
        self.grams, self.starts, self.marked = g.astype(np.int32), np.cumsum(self.sizes) - self.sizes, np.zeros(len(df), bool)
        self.ends = np.concatenate([[0], np.cumsum(df)]).tolist()
        self.lists = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)[np.argsort(g, kind="stable")]
        self.rows = {}
        for i in np.flatnonzero(df > len(self.sizes) / DENSE).tolist():
            self.rows[i] = np.zeros(len(self.sizes), np.uint8)
            self.rows[i][self.list(i)] = 1
        self.counts = np.zeros(len(self.sizes), np.uint8)

    def list(self, i: int) -> np.ndarray:
        return self.lists[self.ends[i] : self.ends[i + 1]]

    def count(self, shared: np.ndarray, ids: np.ndarray) -> None:
        for i in ids.tolist():
            if i in self.rows:
                shared += self.rows[i]
            else:
                shared[self.list(i)] += 1

    def best(self, grams: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the ``k`` names most like the one with these grams, and their likeness in millionths; equals in the order of the names."""
        n, at = len(grams), np.minimum(np.searchsorted(self.vocabulary, grams), len(self.vocabulary) - 1)
        shared = self.counts if n < 256 else np.zeros(len(self.sizes), np.int32)
        shared[:] = 0
        # at least floor of a name's own grams are shared, less what rounding to millionths forgives
        need, ids = max(1, int(np.ceil((floor - 1e-6) * n))), at[self.vocabulary[at] == grams]
        if len(ids) < need:
            return NONE
        # of the rarest, but need - 1, one is shared; where that leaves few names, only their grams are looked at
        ids = ids[np.argsort(self.df[ids], kind="stable")]
        rare = len(ids) - need + 1 if floor >= 0.5 else len(ids)
        self.count(shared, ids[:rare])
        rest = ids[rare:]
        c = np.flatnonzero(shared >= (1 if len(rest) else need))
        if not len(c):
            return NONE
        if len(rest) and len(c) * FEW < len(self.sizes):
            size = self.sizes[c]
            end = np.cumsum(size)
            self.marked[rest] = True
            x = shared[c] + np.add.reduceat(self.marked[self.grams[np.arange(end[-1]) + np.repeat(self.starts[c] - (end - size), size)]].astype(np.int64), end - size)
            self.marked[rest] = False
            c, x = c[x >= need], x[x >= need]
        else:
            if len(rest):
                self.count(shared, rest)
                c = np.flatnonzero(shared >= need)
            x = shared[c].astype(np.int64)
        all_ = n + self.sizes[c] - x
        like = (2_000_000 * x + all_) // (2 * all_)
        c, like = c[like >= round(floor * 1e6)], like[like >= round(floor * 1e6)]
        if len(c) > 8 * k:
            least = np.partition(like, len(like) - k)[len(like) - k]
            c, like = c[like >= least], like[like >= least]
        first = np.lexsort((c, -like))[:k]
        return c[first], like[first]


def _search(k: int, floor: float):
    """Batches of group, side (0 held, 1 asked), name, grams, sorted by group, side and name, to kind, lname, rname, millionths."""

    def answers(held: Held, kind: str, asked: pa.RecordBatch) -> pa.RecordBatch:
        sizes, grams = pc.list_value_length(asked.column("g")).to_numpy(zero_copy_only=False), asked.column("g").flatten().to_numpy(zero_copy_only=False)
        found = [held.best(x, k, floor) for x in np.split(grams, np.cumsum(sizes)[:-1])]
        l, r = np.repeat(np.arange(len(found)), [len(c) for c, _ in found]), np.concatenate([c for c, _ in found])
        cols = [pa.array([kind] * len(l), pa.string()), asked.column("name").take(pa.array(l)), held.names.take(pa.array(r)), pa.array(np.concatenate([x for _, x in found]), pa.int64())]
        return pa.RecordBatch.from_arrays(cols, ["kind", "lname", "rname", "millionths"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, held = None, [], None
        for b in batches:
            runs, start = pc.run_end_encode(b.column("group")), 0
            for g, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                if g != group:
                    group, parts, held = g, [], None
                own = b.slice(start, end - start)
                cut = int(np.searchsorted(own.column("side").to_numpy(), 1))
                if cut:
                    parts.append(own.slice(0, cut))
                if cut < len(own):
                    if held is None and parts:
                        held, parts = Held(pa.concat_arrays([p.column("name") for p in parts]), pa.concat_arrays([p.column("g") for p in parts])), []
                    if held is not None:
                        yield answers(held, g.split(":", 2)[2], own.slice(cut))
                start = end

    return run


def nearest_names(asked: DataFrame, held: DataFrame, k: int, floor: float, tmp: Scratch) -> DataFrame:
    """kind, lname, rname, similarity: for each name asked the ``k`` most similar names held of its kind in each block of ``HELD``, which has the ``k`` of all among them.

    A task holds one block of names and answers one share of the names asked of that kind, so what goes between tasks is names and at most ``k`` answers to each, never pairs. Names without a gram
    match nothing, nor do null names and kinds.
    """
    names = asked.select("kind", "name", F.lit(1).alias("side")).unionAll(held.select("kind", "name", F.lit(0).alias("side"))).filter("kind is not null and name is not null").distinct()
    names = tmp.keep(names, "names")
    n = lambda side: F.count(F.when(F.col("side") == side, 1))
    dealt = names.groupBy("kind").agg(n(0).alias("_h"), n(1).alias("_a")).filter("_h > 0 and _a > 0")
    dealt = dealt.select("kind", F.ceil(F.col("_h") / HELD).cast("int").alias("_h"), F.least(F.ceil(F.col("_a") / ASKED), F.lit(SHARES)).cast("int").alias("_a"))
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    one = lambda c: F.array(F.pmod(F.xxhash64("name"), F.col(c)).cast("int"))
    x = names.join(F.broadcast(dealt), "kind").withColumn("_b", F.explode(F.when(F.col("side") == 0, one("_h")).otherwise(every("_h")))).withColumn("_s", F.explode(F.when(F.col("side") == 0, every("_a")).otherwise(one("_a"))))
    x = x.select(F.concat_ws(":", "_b", "_s", "kind").alias("group"), "side", "name")
    spark = asked.sparkSession
    tasks = max(8 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    x = x.repartition(tasks, "group").sortWithinPartitions("group", "side", "name")
    # grams are made where they are used: names are shorter
    x = x.withColumn("g", F.transform(grams(F.col("name")), lambda t: F.xxhash64(t))).filter("size(g) > 0")
    found = x.mapInArrow(_search(k, floor), "kind string, lname string, rname string, millionths long")
    return found.select("kind", "lname", "rname", (F.col("millionths") / F.lit(1e6)).alias("similarity"))


def top_candidates(queries: DataFrame, records: DataFrame, k: int = 5, floor: float = 0.3) -> DataFrame:
    """id, uid, name, similarity, place: the ``k`` most similar names of active records of the query's kind, by similarity, name, uid.

    ``queries``: id, kind, name; ``records``: uid, kind, name, is_active, canonical_uid. uid is that of the record the name leads to; a name that leads to no record of the table
    keeps its place and gives no row.
    """
    tmp = Scratch(queries.sparkSession, "candidates")
    live = records.filter("is_active").select("uid", "kind", F.col("name").alias("rname"), F.coalesce("canonical_uid", "uid").alias("canonical"))
    hits = nearest_names(queries, live.select("kind", F.col("rname").alias("name")), k, floor, tmp).join(live, ["kind", "rname"])
    w = Window.partitionBy("kind", "lname").orderBy(F.col("similarity").desc(), "rname", "uid")
    best = hits.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)
    there = records.select(F.col("uid").alias("canonical")).distinct()
    found = tmp.keep(best.join(there, "canonical", "left_semi"), "found")
    return queries.select("id", "kind", F.col("name").alias("lname")).join(found, ["kind", "lname"]).select("id", F.col("canonical").alias("uid"), F.col("rname").alias("name"), "similarity", "place")


def best_of_searches(native: DataFrame, romanised: DataFrame, ceiling: float = 0.9) -> DataFrame:
    """id, uid, similarity of two searches together: romanised hits count at most ``ceiling``, the best hit of a record stays."""
    both = native.select("id", "uid", "similarity").unionAll(romanised.select("id", "uid", F.least("similarity", F.lit(ceiling)).alias("similarity")))
    return both.groupBy("id", "uid").agg(F.max("similarity").alias("similarity"))


# Fields that say who something is, and fields that say a little.
STRONG = (
    "Affiliations(groupName)", "Parent Organisation", "Street Address", "Postal Code", "Awards", "Education", "Birth Year (yyyy)",
    "Place of Birth", "Founder", "Group Members", "Spouse", "Child", "Parent",
)
WEAK = ("Occupation", "Feature Type", "Title", "Category")
STRONG_BONUS, WEAK_BONUS, MOST_BONUS, LONG = 0.20, 0.08, 0.45, 8
DEATH = "Death Year (yyyy)"
ABOUT_A_DEATH = r"(?i)\b(the late|died|death|passed away|posthumous|obituar|memorial)\b|逝世|去世|已故|离世"


def shared_fields(a: str, b: str) -> Column:
    """The telling fields, sorted, under which two maps hold a common value, or one value within another, both of eight characters or more."""

    def common(k: str) -> Column:
        x, y = loose_values(F.try_element_at(a, F.lit(k))), loose_values(F.try_element_at(b, F.lit(k)))
        within = F.exists(x, lambda p: F.exists(y, lambda q: (F.length(p) >= LONG) & (F.length(q) >= LONG) & (p.contains(q) | q.contains(p))))
        return F.when(F.arrays_overlap(x, y) | within, F.lit(k))

    return F.array_compact(F.array(*[common(k) for k in sorted((*STRONG, *WEAK))]))


def bonus(shared: Column) -> Column:
    """What shared fields add to a likeness."""
    strong = F.size(F.array_intersect(shared, F.array(*map(F.lit, STRONG))))
    return F.least(strong * STRONG_BONUS + (F.size(shared) - strong) * WEAK_BONUS, F.lit(MOST_BONUS))


def impossible(record_fields: Column, fields: Column, kind: Column, said: Column, year: Column) -> Column:
    """A person recorded dead two years or more before the article, unless the mention has a death year or what is said is about a death."""
    died = F.trim(F.coalesce(F.try_element_at(record_fields, F.lit(DEATH)), F.lit("")))
    dead = F.when(died.rlike("^[0-9]{1,9}$"), died.cast("int") < year - 1)
    own = F.coalesce(F.array_contains(F.map_keys(fields), DEATH), F.lit(False))
    return F.coalesce((kind == "PERSON") & dead & ~own & ~F.coalesce(said, F.lit("")).rlike(ABOUT_A_DEATH), F.lit(False))


def rank(pairs: DataFrame, keep: int = 5) -> DataFrame:
    """extracted_id, uid, overlap, score, place: candidates that are possible, by name likeness and shared fields together, likeness, uid; the first ``keep``.

    ``pairs``: extracted_id, uid, similarity, kind, fields, record_fields, said (what is said of the mention), year (of the article).
    """
    x = pairs.filter(~impossible(F.col("record_fields"), F.col("fields"), F.col("kind"), F.col("said"), F.col("year")))
    x = x.withColumn("overlap", shared_fields("fields", "record_fields")).withColumn("score", F.floor((F.col("similarity") + bonus(F.col("overlap"))) * 1000 + 0.500001) / 1000)
    w = Window.partitionBy("extracted_id").orderBy(F.col("score").desc(), F.col("similarity").desc(), "uid")
    return x.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= keep).select("extracted_id", "uid", "overlap", "score", "place")
