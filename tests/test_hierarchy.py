"""Trees and rings against a walk in plain Python."""

import random

from authlens.operators.hierarchy import descendants, hierarchy


def walk(parent, node):
    seen = [node]
    while seen[-1] in parent:
        up = parent[seen[-1]]
        if up in seen:
            return min(seen[seen.index(up):]), True
        seen.append(up)
    return seen[-1], False


def test_random_forest_with_rings(spark):
    rng = random.Random(3)
    parent = {f"n{i:03}": f"n{rng.randrange(60):03}" for i in range(60) if rng.random() < 0.8}
    parent |= {f"c{i:02}": f"c{i + 1:02}" for i in range(30)} | {"self": "self"}
    out = {r.node: r for r in hierarchy(spark.createDataFrame([("", a, b) for a, b in parent.items()] + [("", "x", None)], "scope string, child string, parent string")).collect()}
    assert set(out) == set(parent)
    for n, r in out.items():
        root, ring = walk(parent, n)
        assert (r.root, r.cycle != "no") == (root, ring)
        if not ring:
            assert r.path[0] == root and r.path[-1] == n and len(r.path) == r.depth + 1
    assert out["self"].cycle == "on"


def test_descendants_and_empty(spark):
    h = hierarchy(spark.createDataFrame([("", "b", "a"), ("", "c", "b"), ("", "d", "b")], "scope string, child string, parent string"))
    assert {(r.ancestor, r.node, r.distance) for r in descendants(h).collect()} == {("a", "b", 1), ("a", "c", 2), ("b", "c", 1), ("a", "d", 2), ("b", "d", 1)}
    assert hierarchy(spark.createDataFrame([], "scope string, child string, parent string")).count() == 0


def test_trees_below_a_ring(spark):
    h = hierarchy(spark.createDataFrame([("", "a", "b"), ("", "b", "a"), ("", "c", "b"), ("", "d", "c"), ("", "y", "x")], "scope string, child string, parent string"))
    got = {r.node: (r.root, r.depth, r.path, r.cycle) for r in h.collect()}
    assert got == {"a": ("a", None, None, "on"), "b": ("a", None, None, "on"), "c": ("a", 1, ["b", "c"], "below"), "d": ("a", 2, ["b", "c", "d"], "below"), "y": ("x", 1, ["x", "y"], "no")}
    assert {(r.ancestor, r.node, r.distance) for r in descendants(h).collect()} == {("b", "c", 1), ("c", "d", 1), ("b", "d", 2), ("x", "y", 1)}
