"""Evaluation: agreement, ranking metrics, threshold sweeps, intervals, allocation and stratified draws."""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Parts into which the different scores of one group are split, so that no running sum is one task's.
BUCKETS = 256


def cumulative(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row a different score (``by``, score): rows, positives, and both from the highest score down (tp, seen), with totals.

    Rows are summed by score first. Scores are then cut into ranges; running sums are made within each range, and the sums of the ranges above, of which there are at most ``BUCKETS`` a group,
    are added, so that neither all rows nor all scores of a group are in one task.
    """
    by = by or []
    per = scored.groupBy(*by, "score").agg(F.count("*").alias("n"), F.sum(F.col("label").cast("long")).alias("pos"))
    ends = per.groupBy(*by).agg(F.min("score").alias("_lo"), F.max("score").alias("_hi"), F.sum("n").alias("all_n"), F.sum("pos").alias("all_pos"))
    per = per.join(ends, by) if by else per.join(F.broadcast(ends), F.lit(True))
    share = (F.col("_hi") - F.col("score")) / F.nullif((F.col("_hi") - F.col("_lo")).cast("double"), F.lit(0.0))
    per = per.withColumn("_b", F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BUCKETS), F.lit(BUCKETS - 1)))
    whole = per.groupBy(*by, "_b").agg(F.sum("n").alias("_n"), F.sum("pos").alias("_pos"))
    above = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(*by, "_b", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n"), F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("_pos"))
    down = Window.partitionBy(*by, "_b").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = per.join(whole, [*by, "_b"]).withColumn("seen", F.sum("n").over(down) + F.col("_n")).withColumn("tp", F.sum("pos").over(down) + F.col("_pos"))
    return x.select(*by, "score", "n", "pos", "seen", "tp", "all_n", "all_pos")


def rank_auc(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """by, auc: share of (positive, negative) pairs in the right order, ties half; null where one class is missing."""
    by = by or []
    c = cumulative(scored, by)
    # rank of a score from below, averaged over its ties
    rank = (F.col("all_n") - F.col("seen")) + (F.col("n") + 1) / 2
    neg = F.max(F.col("all_n") - F.col("all_pos"))
    pos = F.max("all_pos")
    auc = (F.sum(rank * F.col("pos")) - pos * (pos + 1) / 2) / F.nullif(pos * neg, F.lit(0))
    return c.groupBy(*by).agg(F.round(auc, 6).alias("auc"))


def best_f1(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """by, threshold, f1: the score at or above which calling rows positive has the best F1; ties to the higher score."""
    by = by or []
    f1 = F.round(2 * F.col("tp") / (F.col("seen") + F.col("all_pos")), 6)
    return cumulative(scored, by).withColumn("f1", f1).groupBy(*by).agg(F.max(F.struct("f1", "score")).alias("m")).select(*by, F.col("m.score").alias("threshold"), "m.f1")


def recall_threshold(scored: DataFrame, target: float = 0.95, by: list[str] | None = None) -> DataFrame:
    """by, threshold, passed: the highest score whose recall reaches ``target`` and the share of rows at or above it."""
    by = by or []
    c = cumulative(scored, by).filter(F.col("tp") >= target * F.col("all_pos"))
    return c.groupBy(*by).agg(F.max_by(F.round(F.col("seen") / F.col("all_n"), 6), "score").alias("passed"), F.max("score").alias("threshold"))


def precision_at_recall(scored: DataFrame, target: float = 0.95, by: list[str] | None = None) -> DataFrame:
    """by, threshold, precision: the best precision among the scores whose recall reaches ``target``; ties to the higher score."""
    by = by or []
    c = cumulative(scored, by).filter(F.col("tp") >= target * F.col("all_pos")).withColumn("precision", F.round(F.col("tp") / F.col("seen"), 6))
    return c.groupBy(*by).agg(F.max(F.struct("precision", "score")).alias("m")).select(*by, F.col("m.score").alias("threshold"), "m.precision")


def average_precision(scored: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """by, ap: the mean of the precision at each positive row, rows from the highest score down, rows of one score in the order of ``key``.

    Rows of one score are few beside all rows; above them only the sums of :func:`cumulative` count.
    """
    by = by or []
    c = cumulative(scored, by).select(*by, "score", (F.col("seen") - F.col("n")).alias("_seen"), (F.col("tp") - F.col("pos")).alias("_tp"))
    inside = Window.partitionBy(*by, "score").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = scored.withColumn("_k", F.count("*").over(inside)).withColumn("_p", F.sum("label").over(inside)).join(c, [*by, "score"])
    precision = (F.col("_tp") + F.col("_p")) / (F.col("_seen") + F.col("_k"))
    return x.groupBy(*by).agg(F.round(F.avg(F.when(F.col("label") == 1, precision)), 6).alias("ap"))


def prf(scored: DataFrame, threshold: Column, by: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """by, tp, fp, fn, tn, precision, recall, f1, flagged: the (weighted) counts of calling rows at or above ``threshold`` positive; a share of nothing is null."""
    w = F.col(weight) if weight else F.lit(1)
    said, true = F.col("score") >= threshold, F.col("label") == 1
    of = lambda c: F.sum(F.when(c, w).otherwise(0))
    t = scored.groupBy(*(by or [])).agg(of(said & true).alias("tp"), of(said & ~true).alias("fp"), of(~said & true).alias("fn"), of(~said & ~true).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    share = lambda a, b: F.round(a / F.nullif(b, F.lit(0)), 6)
    return t.withColumns({"precision": share(tp, tp + fp), "recall": share(tp, tp + fn), "f1": share(2 * tp, 2 * tp + fp + fn), "flagged": share(tp + fp, tp + fp + fn + tn)})


def carried_threshold(scored: DataFrame, dev: Column, by: list[str] | None = None) -> DataFrame:
    """part, by, threshold and :func:`prf` on rows of which ``dev`` holds and on the others, at the best-F1 score of the former; all rows and each value of ``by``."""
    x = scored.withColumn("part", F.when(dev, "dev").otherwise("held"))
    t = F.broadcast(best_f1(x.filter("part = 'dev'")).select("threshold"))
    x = x.join(t, F.lit(True))
    whole = prf(x, F.col("threshold"), ["part", "threshold"])
    parts = prf(x, F.col("threshold"), ["part", "threshold", *(by or [])])
    for c in by or []:
        whole = whole.withColumn(c, F.lit(None).cast(dict(parts.dtypes)[c]))
    return whole.select(parts.columns).unionByName(parts) if by else whole


def tune_cutoffs(scored: DataFrame, highs: list[float], lows: list[float]) -> DataFrame:
    """hi, lo, agree, rows: for each pair of a grid (a few dozen), the share of rows judged as they are labelled, where a score of ``hi`` or more means yes and one under ``lo`` no; between them no row is judged and none agrees."""
    grid = scored.sparkSession.createDataFrame([(float(h), float(x)) for h in highs for x in lows if x <= h], "hi double, lo double")
    per = scored.groupBy("score", "label").agg(F.count("*").alias("n"))
    right = F.when((F.col("score") >= F.col("hi")) & (F.col("label") == 1), F.col("n")).when((F.col("score") < F.col("lo")) & (F.col("label") == 0), F.col("n")).otherwise(0)
    return per.join(F.broadcast(grid), F.lit(True)).groupBy("hi", "lo").agg(F.round(F.sum(right) / F.sum("n"), 6).alias("agree"), F.sum("n").alias("rows"))


# The width of a 95 % range, its ends, and how many draws stand for a distribution.
Z, ENDS, DRAWS, REDRAWS = 1.96, (2.5, 97.5), 20_000, 2_000


def margin(p: Column, n: Column) -> Column:
    """Half the width of the usual 95 % range of a share counted on ``n`` rows; 1 where there are none."""
    return F.when(n > 0, Z * F.sqrt(p * (1 - p) / n)).otherwise(F.lit(1.0))


def jeffreys(hits: Column, n: Column, seed: int = 1) -> Column:
    """Struct lo, hi: the 95 % range of a share of ``hits`` in ``n``, from draws of Beta(hits + 1/2, n - hits + 1/2); null where n is 0."""

    def ends(h: pd.Series, k: pd.Series) -> pd.DataFrame:
        out = []
        for a, b in zip(h, k):
            if not b or math.isnan(b):
                out.append((None, None))
                continue
            out.append(tuple(np.percentile(np.random.default_rng(seed).beta(a + 0.5, b - a + 0.5, DRAWS), ENDS)))
        return pd.DataFrame(out, columns=["lo", "hi"])

    return F.pandas_udf(ends, "struct<lo: double, hi: double>")(hits.cast("double"), n.cast("double"))


def strata(rows: DataFrame, stratum: str, weight: str, label: str) -> DataFrame:
    """stratum, size (sum of weights), labelled, yes: what each group stands for, how many of its rows have a label and how many are a yes."""
    return rows.groupBy(stratum).agg(F.sum(weight).alias("size"), F.count(label).alias("labelled"), F.sum(F.coalesce(F.col(label).cast("int"), F.lit(0))).alias("yes"))


def recall_of(groups: DataFrame, kept: Column) -> DataFrame:
    """found, missed, recall: each group's yeses (size, labelled, yes) scaled to its size; ``kept`` holds of the groups that were said yes to. Groups without labels count nothing; recall is null where no kept row was labelled."""
    scaled = F.col("size") * F.col("yes") / F.nullif(F.col("labelled"), F.lit(0))
    t = groups.agg(F.sum(F.when(kept, scaled)).alias("found"), F.coalesce(F.sum(F.when(~kept, scaled)), F.lit(0.0)).alias("missed"))
    return t.withColumn("recall", F.col("found") / F.nullif(F.col("found") + F.col("missed"), F.lit(0.0)))


def recall_range(groups: DataFrame, kept: str, seed: int = 1) -> DataFrame:
    """recall, lo, hi of :func:`recall_of`'s groups (a few strata; ``kept`` BOOLEAN column), each group's share drawn from its own Jeffreys range and scaled to its size."""

    def ranges(b: pd.DataFrame) -> pd.DataFrame:
        rng, f, m, found, missed = np.random.default_rng(seed), 0.0, 0.0, 0.0, 0.0
        for r in b.sort_values(["kept", "size"]).itertuples():
            if not r.labelled:
                continue
            drawn, point = r.size_ * rng.beta(r.yes + 0.5, r.labelled - r.yes + 0.5, DRAWS), r.size_ * r.yes / r.labelled
            f, found = (f + drawn, found + point) if r.kept else (f, found)
            m, missed = (m, missed) if r.kept else (m + drawn, missed + point)
        if isinstance(f, float):
            return pd.DataFrame([(None, None, None)], columns=["recall", "lo", "hi"])
        lo, hi = np.percentile(f / (f + m), ENDS)
        return pd.DataFrame([(found / (found + missed) if found + missed else None, lo, hi)], columns=["recall", "lo", "hi"])

    g = groups.select(F.col("size").cast("double").alias("size"), F.col("size").cast("double").alias("size_"), F.col("labelled").cast("double").alias("labelled"), F.col("yes").cast("double").alias("yes"), F.col(kept).alias("kept"), F.lit(1).alias("one"))
    return g.groupBy("one").applyInPandas(ranges, "recall double, lo double, hi double")


def cluster_range(units: DataFrame, key: str, group: str = "group", weight: str = "weight", redraws: int = REDRAWS, seed: int = 1) -> DataFrame:
    """measure (precision, recall), point, lo, hi from units (articles) that are right or wrong as a whole: ok, bad, missed, each by ``weight``.

    Units are redrawn ``redraws`` times: in each a unit counts as often as a Poisson draw of mean 1 says, seeded by its key, so any task draws the same and only one row of sums a task is shuffled. The range is the middle 95 % of
    the redraws, corrected for bias and for skewness by leaving out one unit at a time, the rest of its group standing for the whole group; the jackknife's sums are a plain aggregation.
    """
    cols = ("ok", "bad", "missed")
    v = units.select(F.xxhash64(F.lit(seed), F.col(key)).alias("k"), F.col(group).alias("g"), *[(F.col(weight) * F.col(c)).cast("double").alias(c) for c in cols])

    def draw_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((3, redraws))
        for b in batches:
            for k, *x in b[["k", *cols]].itertuples(index=False, name=None):
                n = np.random.default_rng(int(k) & (2**63 - 1)).poisson(1.0, redraws)
                for i in range(3):
                    if x[i]:
                        sums[i] += x[i] * n
        yield pd.DataFrame({c: [sums[i].tolist()] for i, c in enumerate(cols)})

    drawn = v.mapInPandas(draw_, ", ".join(f"{c} array<double>" for c in cols)).select(F.posexplode(F.arrays_zip(*cols)).alias("rep", "x"))
    drawn = drawn.groupBy("rep").agg(*[F.sum(F.col("x")[c]).alias(c) for c in cols])
    total = v.agg(*[F.sum(c).alias(f"t_{c}") for c in cols])
    per = v.groupBy("g").agg(F.count("*").alias("n"), *[F.sum(c).alias(f"g_{c}") for c in cols])
    out = None
    for name, rest in (("precision", "bad"), ("recall", "missed")):
        t = total.select(F.col("t_ok").alias("a"), F.col(f"t_{rest}").alias("b")).withColumn("point", F.col("a") / F.nullif(F.col("a") + F.col("b"), F.lit(0.0)))
        d = drawn.select((F.col("ok") / F.nullif(F.col("ok") + F.col(rest), F.lit(0.0))).alias("s")).filter("s is not null").agg(F.array_sort(F.collect_list("s")).alias("spread"))
        left = v.join(F.broadcast(per), "g").filter("n > 1").join(F.broadcast(t), F.lit(True))
        without = lambda whole, grp, own: F.col(whole) - F.col(grp) + (F.col(grp) - F.col(own)) * F.col("n") / (F.col("n") - 1)
        p, q = without("a", "g_ok", "ok"), without("b", f"g_{rest}", rest)
        jack = left.select((p / F.nullif(p + q, F.lit(0.0))).alias("j")).filter("j is not null")
        mean = F.broadcast(jack.agg(F.avg("j").alias("m")))
        acc = jack.join(mean, F.lit(True)).agg(F.sum(F.pow(F.col("m") - F.col("j"), 3)).alias("cube"), F.sum(F.pow(F.col("m") - F.col("j"), 2)).alias("square"))
        one = t.select("point").join(d, F.lit(True)).join(acc, F.lit(True)).select(F.lit(name).alias("measure"), "point", "spread", "cube", "square")
        out = one if out is None else out.unionByName(one)

    def ends(b: pd.DataFrame) -> pd.DataFrame:
        norm, rows = NormalDist(), []
        for r in b.itertuples():
            s = np.asarray(r.spread, float)
            if r.point is None or math.isnan(r.point) or not len(s):
                rows.append((r.measure, None, None, None))
                continue
            below = np.clip(np.mean(s < r.point) + np.mean(s == r.point) / 2, 1 / len(s), 1 - 1 / len(s))
            z0 = norm.inv_cdf(float(below))
            a = r.cube / (6 * r.square**1.5) if r.square else 0.0
            cut = [100 * norm.cdf(z0 + (z0 + z) / (1 - a * (z0 + z))) for z in map(norm.inv_cdf, (0.025, 0.975))]
            rows.append((r.measure, r.point, *map(float, np.percentile(s, cut))))
        return pd.DataFrame(rows, columns=["measure", "point", "lo", "hi"])

    return out.mapInPandas(lambda bs: map(ends, bs), "measure string, point double, lo double, hi double")


def coverage(spark, groups: list[tuple[str, int, float, int]], sims: int = 2000, seed: int = 1) -> DataFrame:
    """group, truth, average, inside: made-up groups (name, size, share of yeses, rows drawn) drawn ``sims`` times, and how often the Jeffreys range of the share held the truth. Draws are split over tasks."""

    def play(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i in b.id:
                rng = np.random.default_rng((seed, int(i)))
                for name, size, share, n in groups:
                    yes = round(size * share)
                    hit = rng.hypergeometric(yes, size - yes, n)
                    lo, hi = np.percentile(rng.beta(hit + 0.5, n - hit + 0.5, DRAWS // 10), ENDS)
                    rows.append((name, yes / size, hit / n, bool(lo <= yes / size <= hi)))
            yield pd.DataFrame(rows, columns=["group", "truth", "share", "held"])

    drawn = spark.range(sims).mapInPandas(play, "group string, truth double, share double, held boolean")
    return drawn.groupBy("group", "truth").agg(F.avg("share").alias("average"), F.avg(F.col("held").cast("int")).alias("inside"))


def kappa(votes: DataFrame) -> DataFrame:
    """task, a, b, items, agreed, kappa (null where chance agreement is 1) of labeller pairs; ``votes``: task, item, labeller, label, one a labeller and item."""
    x, y = votes.alias("x"), votes.alias("y")
    pairs = x.join(y, (F.col("x.task") == F.col("y.task")) & (F.col("x.item") == F.col("y.item")) & (F.col("x.labeller") < F.col("y.labeller")))
    cell = pairs.groupBy(F.col("x.task").alias("task"), F.col("x.labeller").alias("a"), F.col("y.labeller").alias("b"), F.col("x.label").alias("la"), F.col("y.label").alias("lb")).agg(F.count("*").alias("n"))
    key = ["task", "a", "b"]
    rows = cell.groupBy(*key, F.col("la").alias("l")).agg(F.sum("n").alias("ra"))
    cols = cell.groupBy(*key, F.col("lb").alias("l")).agg(F.sum("n").alias("rb"))
    chance = rows.join(cols, [*key, "l"]).groupBy(*key).agg(F.sum(F.col("ra") * F.col("rb")).alias("c"))
    total = cell.groupBy(*key).agg(F.sum("n").alias("items"), F.sum(F.when(F.col("la") == F.col("lb"), F.col("n")).otherwise(0)).alias("agreed"))
    pe = F.coalesce("c", F.lit(0)) / (F.col("items") * F.col("items"))
    po = F.col("agreed") / F.col("items")
    return total.join(chance, key, "left").select(*key, "items", "agreed", F.when(pe < 1, F.round((po - pe) / (1 - pe), 6)).alias("kappa"))


def allocate(strata: DataFrame, total: int) -> DataFrame:
    """stratum, size, share of ``total``: in proportion to size, the rest to the largest remainders (ties by stratum), never above the size."""
    exact = F.col("size") * F.lit(float(total)) / F.sum("size").over(Window.partitionBy(F.lit(1)))
    s = strata.withColumn("base", F.floor(exact)).withColumn("part", F.round(exact - F.floor(exact), 9))
    rest = F.lit(total) - F.sum("base").over(Window.partitionBy(F.lit(1)))
    s = s.withColumn("rest", rest).withColumn("n", F.row_number().over(Window.orderBy(F.col("part").desc(), "stratum")))
    return s.select("stratum", "size", F.least(F.col("size"), F.col("base") + (F.col("n") <= F.col("rest")).cast("long")).alias("share"))


def draw(rows: DataFrame, by: list[str], key: str, each: int, seed: str = "1") -> DataFrame:
    """Adds weight to the rows drawn: ``each`` of every stratum, in the order of a seeded digest of the key; weight is the stratum's size over its draw."""
    w = Window.partitionBy(*by)
    order = F.md5(F.concat(F.lit(seed + ":"), F.col(key).cast("string")))
    picked = rows.withColumn("_n", F.row_number().over(w.orderBy(order, key))).withColumn("_size", F.count("*").over(w)).filter(F.col("_n") <= each)
    return picked.withColumn("weight", F.round(F.col("_size") / F.least("_size", F.lit(each)), 6)).drop("_n", "_size")
