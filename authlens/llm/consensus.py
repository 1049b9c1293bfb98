"""Consensus of several labellers by the triplet method of moments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The keys a label may hold and its values as they are written out.
VALUES = {"relevant": ("true", "false"), "same": ("Y", "N"), "verdict": ("correct", "partial", "wrong")}


def usable_votes(labels: DataFrame) -> DataFrame:
    """task, item, labeller, label: the last label of each labeller on an item, where it is usable.

    Last by ``labelled_at`` (null earliest), ties by the larger label text. Values are read without case and outer
    space; null, ``{}``, ``?``, text that is no JSON and unknown values are not usable. Rows without task, item or
    labeller are ignored. Columns of other names are not read.
    """
    last = labels.filter("task is not null and item is not null and labeller is not null").groupBy("task", "item", "labeller").agg(
        F.max_by("label", F.struct(F.coalesce(F.col("labelled_at"), F.timestamp_seconds(F.lit(0))), F.coalesce("label", F.lit("")))).alias("label")
    )
    read = [
        F.when(F.lower(F.trim(F.get_json_object("label", f"$.{key}"))) == v.lower(), v) for key, values in VALUES.items() for v in values
    ]
    return last.select("task", "item", "labeller", F.coalesce(*read).alias("label")).filter("label is not null")


def pair_agreement(votes: DataFrame) -> DataFrame:
    """a, b (a < b), n, c: items two labellers share and their agreement corrected for chance, over all tasks.

    Chance is what two labellers agree on who draw from the task's shares of labels. An item's votes are one array, at
    most one vote a labeller, and pairs are summed before the shuffle, so that it carries at most labellers squared.
    """
    shares = votes.groupBy("task", "label").agg(F.count("*").alias("n")).withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("task")))
    chance = shares.groupBy("task").agg(F.sum(F.col("p") * F.col("p")).alias("chance"))
    items = votes.groupBy("task", "item").agg(F.sort_array(F.collect_list(F.struct("labeller", "label"))).alias("v"))
    first = items.select("task", "v", F.posexplode("v").alias("i", "x"))
    pairs = first.select("task", "x", F.explode(F.slice("v", F.col("i") + 2, F.size("v"))).alias("y"))
    per_task = pairs.groupBy("task", F.col("x.labeller").alias("a"), F.col("y.labeller").alias("b")).agg(
        F.count("*").alias("n"), F.sum((F.col("x.label") == F.col("y.label")).cast("int")).alias("same")
    )
    c = (F.col("same") / F.col("n") - F.col("chance")) / F.greatest(1 - F.col("chance"), F.lit(1e-6))
    return per_task.join(chance, "task").groupBy("a", "b").agg(F.sum("n").alias("n"), (F.sum(c * F.col("n")) / F.sum("n")).alias("c"))


def labeller_skill(pairs: DataFrame, least: int = 3, prior: float = 0.6, weight: float = 20.0) -> DataFrame:
    """labeller, skill, triplets: the share of items a labeller knows, the rest being drawn by chance.

    Agreement above chance of labellers i, j is skill_i * skill_j, so for each triplet skill_i squared is
    c_ij * c_ik / c_jk. Over all triplets whose pairs share at least ``least`` items, numerators are regressed on
    denominators, weighted by the scarcest pair. The sign is that of the labeller's mean agreement. ``weight`` pseudo
    items draw the square towards ``prior`` squared, which holds a labeller of few items near the middle. A labeller in no
    triplet gets ``prior``.
    """
    both = pairs.filter(F.col("n") >= least)
    both = both.select("a", "b", "n", "c").unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"), "n", "c"))
    ij = both.select(F.col("a").alias("i"), F.col("b").alias("j"), F.col("n").alias("nij"), F.col("c").alias("cij"))
    ik = both.select(F.col("a").alias("i"), F.col("b").alias("k"), F.col("n").alias("nik"), F.col("c").alias("cik"))
    jk = both.filter("a < b").select(F.col("a").alias("j"), F.col("b").alias("k"), F.col("n").alias("njk"), F.col("c").alias("cjk"))
    t = jk.join(ij, "j").join(ik, ["i", "k"]).withColumn("w", F.least("nij", "nik", "njk").cast("double"))
    moment = t.groupBy("i").agg(
        F.sum(F.col("w") * F.col("cij") * F.col("cik") * F.col("cjk")).alias("up"), F.sum(F.col("w") * F.col("cjk") * F.col("cjk")).alias("down"), F.count("*").alias("triplets")
    )
    seen = pairs.select(F.col("a").alias("i"), "n", "c").unionByName(pairs.select(F.col("b").alias("i"), "n", "c")).groupBy("i").agg(F.sum(F.col("n") * F.col("c")).alias("side"), F.sum("n").alias("items"))
    square = (F.coalesce("up", F.lit(0.0)) + weight * prior**4) / (F.coalesce("down", F.lit(0.0)) + weight * prior**2)
    skill = F.least(F.sqrt(F.greatest(square, F.lit(0.0004))), F.lit(0.98)) * F.when(F.col("side") < 0, -1).otherwise(1)
    return seen.join(moment, "i", "left").select(F.col("i").alias("labeller"), skill.alias("skill"), F.coalesce("triplets", F.lit(0)).alias("triplets"))


def consensus(votes: DataFrame, skill: DataFrame, prior: float = 0.6) -> DataFrame:
    """task, item, label, votes, agreement, confidence.

    Each label's score is the log of its share in the task plus the log-odds weight of every vote under the labeller's
    skill; the highest wins, ties go to the larger share, then to the smaller label. ``agreement`` is the share of
    pairs of votes that agree (null for one vote), ``confidence`` the winner's posterior. A labeller without a skill has ``prior``.
    """
    shares = votes.groupBy("task", "label").agg(F.count("*").alias("n")).withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("task")))
    known = votes.join(skill.select("labeller", "skill"), "labeller", "left").join(shares.select("task", "label", "p"), ["task", "label"])
    s = F.coalesce("skill", F.lit(prior))
    hit = F.greatest(F.abs(s) + (1 - F.abs(s)) * F.col("p"), F.lit(1e-9))
    miss = F.greatest((1 - F.abs(s)) * F.col("p"), F.lit(1e-9))
    gain = F.when(s >= 0, F.log(hit / miss)).otherwise(-F.log(hit / miss))
    tally = known.withColumn("gain", gain).groupBy("task", "item", "label").agg(F.sum("gain").alias("gain"), F.count("*").alias("k"))
    per = Window.partitionBy("task", "item")
    tally = tally.join(shares.select("task", "label", "p"), ["task", "label"]).withColumn("score", F.col("gain") + F.log("p"))
    tally = tally.withColumn("votes", F.sum("k").over(per)).withColumn("same", F.sum(F.col("k") * (F.col("k") - 1)).over(per)).withColumn("top", F.max("score").over(per))
    tally = tally.withColumn("odds", F.sum(F.exp(F.col("score") - F.col("top"))).over(per))
    # labels nobody chose keep their share of the posterior
    order = per.orderBy(F.col("score").desc(), F.col("p").desc(), "label")
    return (
        tally.withColumn("_n", F.row_number().over(order))
        .filter("_n = 1")
        .select(
            "task", "item", "label", "votes",
            F.when(F.col("votes") > 1, F.col("same") / (F.col("votes") * (F.col("votes") - 1))).alias("agreement"), (1 / F.col("odds")).alias("confidence"),
        )
    )
