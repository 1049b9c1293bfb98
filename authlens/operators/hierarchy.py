"""Parent-child links to full hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .snapshots import squeeze, valid_loads

#: Link types whose target is the parent, and the one whose source is.
TO_PARENT = ("BT", "USE", "CHITOENG", "MAYTOENG", "TAMTOENG")
TO_CHILD = "NT"


def hierarchy(edges: DataFrame, paths: bool = True) -> DataFrame:
    """Path, depth and root of every node with a parent.

    ``edges``: scope, child, parent (STRING). Of several parents of one child the smallest is taken; rows with a null
    end are ignored. Returns scope, node, parent, root (of a ring and below it the ring's smallest node), depth (null on a
    ring), path (root first; null on a ring), cycle (``no``, ``on`` the ring, ``below`` it). Below a ring, path and depth
    count from the node of the ring that the branch hangs from.

    Trees grow level by level from the roots: the frontier (nodes placed last) joins the edges on the parent, so a
    level costs one join and every edge is placed once; there is no limit to the number of levels. A hot parent is spread by the skew handling of the adaptive
    planner, as the frontier holds each parent once. Edges never reached lie on a ring or below one; there, pointers
    are doubled with the smallest node seen, until every pointer stands on a ring and no minimum changes, which takes
    log2(longest walk) joins whatever the ring.
    """
    spark, tmp = edges.sparkSession, Scratch(edges.sparkSession, "hierarchy")
    e = tmp.keep(
        edges.filter("child is not null and parent is not null").groupBy("scope", "child").agg(F.min("parent").alias("parent")), "edges"
    )
    heads = e.select("scope", F.col("parent").alias("node")).distinct().join(e.select("scope", F.col("child").alias("node")), ["scope", "node"], "left_anti")
    frontier = heads.select("scope", "node", F.col("node").alias("root"), *([F.array("node").alias("path")] if paths else []))
    kept = _levels(e, frontier, tmp, paths, "level")
    tree = None
    for x in kept:
        tree = x if tree is None else tree.unionByName(x)
    shape = ["scope", "node", "parent", "root", "depth", *(["path"] if paths else []), "cycle"]
    left = e if tree is None else e.join(tree.select("scope", F.col("node").alias("child")), ["scope", "child"], "left_anti")
    rings = tmp.keep(_rings(left, tmp), "rings")
    out = rings if not paths else rings.filter("cycle = 'on'")
    out = out.select("scope", "node", "parent", "root", F.lit(None).cast("int").alias("depth"), *([F.lit(None).cast("array<string>").alias("path")] if paths else []), "cycle")
    if tree is not None:
        out = tree.withColumn("cycle", F.lit("no")).select(shape).unionByName(out.select(shape))
    if paths:
        below = rings.filter("cycle = 'below'").select("scope", F.col("node").alias("child"), "parent")
        hooks = rings.filter("cycle = 'on'").select("scope", "node", "root", F.array("node").alias("path"))
        for x in _levels(below, hooks, tmp, paths, "below"):
            out = out.unionByName(x.withColumn("cycle", F.lit("below")).select(shape))
    return out.select(shape)


def _levels(rest: DataFrame, frontier: DataFrame, tmp: Scratch, paths: bool, name: str) -> list[DataFrame]:
    """Tables of the edges reached from the frontier (scope, node, root, path), one a level. Edges placed leave the rest whenever they are half of it, so that a deep tree is not read whole at each level."""
    kept, level, since, left = [], 0, [], rest.count()
    while True:
        level += 1
        f = frontier.select("scope", F.col("node").alias("parent"), "root", *([F.col("path").alias("_up")] if paths else []))
        found = rest.join(f, ["scope", "parent"]).select(
            "scope", F.col("child").alias("node"), "parent", "root", F.lit(level).alias("depth"), *([F.concat("_up", F.array("child")).alias("path")] if paths else [])
        )
        found = tmp.keep(found, f"{name}{level}")
        n = found.count()
        if not n:
            break
        kept.append(found)
        since.append((found, n))
        frontier = found
        placed = sum(k for _, k in since)
        if 2 * placed > left:
            gone = since[0][0].select("scope", F.col("node").alias("child"))
            for x, _ in since[1:]:
                gone = gone.unionByName(x.select("scope", F.col("node").alias("child")))
            rest = tmp.keep(rest.join(gone, ["scope", "child"], "left_anti"), f"{name}rest{level}")
            left, since = left - placed, []
            if not left:
                break
    return kept


def _rings(left: DataFrame, tmp: Scratch) -> DataFrame:
    """scope, node, parent, root (the ring's smallest node), cycle for nodes that no root reaches."""
    left = tmp.keep(left, "left")
    walk = left.select("scope", F.col("child").alias("node"), F.col("parent").alias("at"), F.least("child", "parent").alias("low"))
    if left.isEmpty():
        return left.select("scope", F.col("child").alias("node"), "parent", F.col("parent").alias("root"), F.lit("on").alias("cycle"))
    step, ends = 0, -1
    while True:
        step += 1
        ahead = walk.select("scope", F.col("node").alias("at"), F.col("at").alias("_at"), F.col("low").alias("_low"))
        nxt = walk.join(ahead, ["scope", "at"]).select(
            "scope", "node", F.col("_at").alias("at"), F.least("low", "_low").alias("low"), (F.col("_low") < F.col("low")).alias("moved")
        )
        walk = tmp.keep(nxt, f"walk{step}")
        if step > 1:
            tmp.drop(f"walk{step - 1}")
        now, moved = walk.agg(F.countDistinct("scope", "at"), F.sum(F.col("moved").cast("int"))).first()
        if now == ends and not moved:
            break
        ends = now
    ring = walk.select("scope", "at").distinct().join(walk.select("scope", F.col("node").alias("at"), F.col("low").alias("root")), ["scope", "at"])
    return (
        walk.select("scope", "node", "at")
        .join(ring, ["scope", "at"])
        .join(left.select("scope", F.col("child").alias("node"), "parent"), ["scope", "node"])
        .join(ring.select("scope", F.col("at").alias("node"), F.lit(True).alias("_on")), ["scope", "node"], "left")
        .select("scope", "node", "parent", "root", F.when(F.col("_on"), "on").otherwise("below").alias("cycle"))
    )


def descendants(nodes: DataFrame) -> DataFrame:
    """Ancestor pairs (scope, ancestor, node, distance) of :func:`hierarchy`'s rows, those below a ring included; of a ring's nodes a branch has the one it hangs from, and the ring's nodes have no ancestors."""
    up = F.posexplode(F.reverse(F.slice("path", F.lit(1), F.size("path") - 1))).alias("distance", "ancestor")
    return nodes.filter("path is not null").select("scope", "node", up).withColumn("distance", F.col("distance") + 1)


def broader_edges(rows: DataFrame, imports: DataFrame) -> DataFrame:
    """scope (volume), child, parent of the last snapshot of each volume.

    The type is compared without case and outer spaces, uids without outer spaces; a link counts only if both ends
    are records (``key_uid``) of that snapshot. Null uids and types give no link; a record may be its own parent.
    """
    loads = valid_loads(imports).filter("next_snapshot is null").select("load_id", "volume")
    r = rows.join(loads, "load_id").select(
        "volume", F.trim("key_uid").alias("k"), F.trim("related_uid").alias("r"), F.upper(F.trim("relationship_type")).alias("t")
    )
    links = r.filter(F.col("t").isin(*TO_PARENT, TO_CHILD) & (F.col("r") != "") & (F.col("k") != ""))
    turn = F.col("t") == TO_CHILD
    links = links.select("volume", F.when(turn, F.col("r")).otherwise(F.col("k")).alias("child"), F.when(turn, F.col("k")).otherwise(F.col("r")).alias("parent")).distinct()
    keys = r.filter("k <> ''").select("volume", "k").distinct()
    for end in ("child", "parent"):
        links = links.join(keys.withColumnRenamed("k", end), ["volume", end], "left_semi")
    return links.select(F.col("volume").alias("scope"), "child", "parent")


def canonical_edges(entities: DataFrame) -> DataFrame:
    """scope (empty), child, parent: the next record towards the preferred one; null, empty and own uids are none."""
    e = entities.filter((F.col("canonical_uid") != "") & (F.col("canonical_uid") != F.col("uid")))
    return e.select(F.lit("").alias("scope"), F.col("uid").alias("child"), F.col("canonical_uid").alias("parent"))


def record_trees(rows: DataFrame, imports: DataFrame, entities: DataFrame, paths: bool = True) -> DataFrame:
    """:func:`hierarchy` of the trees ``broader`` and ``canonical`` in one pass; scope becomes tree and volume."""
    tag = lambda df, name: df.select(F.concat(F.lit(name + "|"), F.col("scope")).alias("scope"), "child", "parent")
    h = hierarchy(tag(broader_edges(rows, imports), "broader").unionByName(tag(canonical_edges(entities), "canonical")), paths=paths)
    return h.withColumn("tree", F.substring_index("scope", "|", 1))


__all__ = ["broader_edges", "canonical_edges", "descendants", "hierarchy", "record_trees", "squeeze"]
