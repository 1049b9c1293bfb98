"""Items of varying size into containers of fixed capacity.

Linear grouping: items larger than a share of the capacity are sorted and cut into groups of equal number, each
rounded up to its largest; combinations of those few sizes are chosen that fill a container best, again and again
until no group is left; the real items then take the places of their groups, in order, and the small items go where
they leave the least room, new containers being opened last. All of this needs only how many items there are of each size, and
sizes are whole numbers up to the capacity, so planning takes as long for any number of items; the items are then
placed by their rank, each on its own.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fill(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """How many of each size (at most ``left``) fill the capacity best; larger sizes first among equals."""
    best = np.full(capacity + 1, -1, dtype=np.int64)  # best[r]: index of the last size used to reach r
    best[0] = len(sizes)
    trail: list[np.ndarray] = []
    for j, s in enumerate(sizes):
        used = np.zeros(capacity + 1, dtype=np.int32)
        if left[j] and s <= capacity:
            k = 1
            reach = best >= 0
            base = reach.copy()
            while k <= left[j] and k * s <= capacity:
                new = np.zeros_like(reach)
                new[k * s :] = base[: capacity + 1 - k * s]
                new &= ~reach
                used[new] = k
                best[new] = j
                reach |= new
                k += 1
        trail.append(used)
    top = int(np.flatnonzero(best >= 0).max())
    take = [0] * len(sizes)
    for j in range(len(sizes) - 1, -1, -1):
        k = int(trail[j][top])
        take[j] = k
        top -= k * sizes[j]
    return take


def plan(counts: dict[int, int], capacity: int, share: float = 0.1, groups: int = 40) -> list[tuple[int, int, int, int]]:
    """(rank from, rank to, items a container, first container) for items ranked from largest (rank 0) to smallest.

    ``counts``: items of each size, 1 to ``capacity``. ``share``: items above this share of the capacity are grouped;
    ``groups``: number of groups. The rows of the result cover every rank once; their number is bounded by the sizes and the groups.
    """
    sizes = sorted((s for s, n in counts.items() if n > 0), reverse=True)
    first_rank = dict(zip(sizes, np.cumsum([0] + [counts[s] for s in sizes])[:-1].tolist()))
    ends = [first_rank[s] + counts[s] for s in sizes]
    large = [s for s in sizes if s > share * capacity]
    n_large = sum(counts[s] for s in large)
    size_at = lambda rank: sizes[bisect.bisect_right(ends, rank)]
    rows: list[tuple[int, int, int, int]] = []
    rooms: dict[int, list[list[int]]] = {}  # room left -> [first container, number]
    opened = 0
    if n_large:
        cuts = sorted({round(i * n_large / groups) for i in range(groups + 1)})
        top = [size_at(a) for a in cuts[:-1]]
        left = [b - a for a, b in zip(cuts, cuts[1:])]
        at = cuts[:-1]
        at = list(at)
        while any(left):
            j0 = next(j for j, n in enumerate(left) if n)
            rest = left.copy()
            rest[j0] -= 1
            take = fill(top, rest, capacity - top[j0])  # the largest item left is always placed
            take[j0] += 1
            times = min(left[j] // k for j, k in enumerate(take) if k)
            marks = {0, times}
            for j, k in enumerate(take):
                if not k:
                    continue
                a, b = at[j], at[j] + k * times
                rows.append((a, b, k, opened))
                lo, hi = bisect.bisect_right(ends, a), bisect.bisect_right(ends, b - 1)
                for e in ends[lo:hi]:  # where a slot's real size changes
                    marks |= {(e - a) // k, -(-(e - a) // k)}
            order = sorted(m for m in marks if 0 <= m <= times)
            for x, y in zip(order, order[1:]):
                room = capacity - sum(size_at(at[j] + k * x + i) for j, k in enumerate(take) for i in range(k))
                rooms.setdefault(room, []).append([opened + x, y - x])
            for j, k in enumerate(take):
                at[j] += k * times
                left[j] -= k * times
            opened += times
    classes = sorted(r for r in rooms if r > 0)
    for s in sizes[len(large) :]:
        rank, n = first_rank[s], counts[s]
        while n:
            i = bisect.bisect_left(classes, s)
            if i == len(classes):
                k = capacity // s
                m = -(-n // k)
                rooms.setdefault(capacity, []).append([opened, m])
                classes.append(capacity)
                opened += m
                i = len(classes) - 1
            room = classes[i]
            spans = rooms[room]
            span = spans[-1]
            k = min(room // s, n)
            m = min(span[1], n // k)
            rows.append((rank, rank + k * m, k, span[0]))
            after = room - k * s
            if after:
                if after not in rooms or not rooms[after]:
                    bisect.insort(classes, after)
                    rooms[after] = []
                rooms[after].append([span[0], m])
            rank, n = rank + k * m, n - k * m
            if m == span[1]:
                spans.pop()
                if not spans:
                    classes.remove(room)
            else:
                span[0], span[1] = span[0] + m, span[1] - m
    return sorted(rows)


def ranked(items: DataFrame, by: list[str], size: str, order: str, salts: int = 64) -> DataFrame:
    """Adds ``ordinal`` (0, 1, ...) among the rows of the same ``by`` and ``size``. One size may hold a third of all rows: rows are numbered inside salted parts, and the parts' sizes, summed up, are added."""
    part = items.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts)).cast("int"))
    key = [*by, size, "_salt"]
    numbered = part.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(order)))
    before = Window.partitionBy(*by, size).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offset = part.groupBy(*key).agg(F.count("*").alias("_c")).withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    return numbered.join(offset, key).withColumn("ordinal", F.col("_n") - 1 + F.col("_before")).drop("_n", "_before", "_salt")


def pack(items: DataFrame, containers: DataFrame, item: str = "doc_id", size: str = "tokens", share: float = 0.1, groups: int = 40) -> DataFrame:
    """size_name, capacity, container, item, part, size: every item in a container of each capacity.

    ``items``: one row an item, with a whole-number size; ``containers``: size_name, capacity (a small table; capacities
    null or below 1 are ignored). An item above the capacity is split into full containers and one remainder that is
    packed like an item (part numbers its pieces from 0); no other item is split. Items of size 0 or null take no room:
    container is null. Containers are numbered from 0 for each capacity, full ones of split items last.
    """
    spark = items.sparkSession
    caps = [(r[0], int(r[1])) for r in containers.select("size_name", "capacity").filter("capacity > 0").distinct().collect()]
    names = spark.createDataFrame(caps, "size_name string, capacity long") if caps else containers.select("size_name", F.col("capacity").cast("long")).limit(0)
    base = items.select(F.col(item).alias("_item"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("_size"))
    every = base.withColumn("_c", F.explode(F.array(*[F.struct(F.lit(n).alias("size_name"), F.lit(c).cast("long").alias("capacity")) for n, c in caps]))).select("_item", "_size", "_c.*") if caps else base.crossJoin(names).limit(0)
    every = every.withColumn("_full", F.floor(F.col("_size") / F.col("capacity"))).withColumn("_full", F.when(F.col("_size") == F.col("capacity"), F.lit(0)).otherwise(F.col("_full")))
    every = every.withColumn("_rest", F.col("_size") - F.col("_full") * F.col("capacity"))
    some = every.filter("_rest > 0")
    counts: dict[str, dict[int, int]] = {n: {} for n, _ in caps}
    for r in some.groupBy("size_name", "_rest").count().collect():  # at most capacity rows for each capacity
        counts[r[0]][int(r[1])] = r[2]
    plans = {n: plan(counts[n], c, share, groups) for n, c in caps}
    used = {n: max((c0 + (b - a) // k for a, b, k, c0 in plans[n]), default=0) for n, _ in caps}
    look = {}
    for n, _ in caps:
        sizes = sorted(counts[n], reverse=True)
        first = dict(zip(sizes, np.cumsum([0] + [counts[n][s] for s in sizes])[:-1].tolist()))
        look[n] = (first, np.array([r[0] for r in plans[n]], dtype=np.int64), np.array([r[2] for r in plans[n]], dtype=np.int64), np.array([r[3] for r in plans[n]], dtype=np.int64))
    shared = spark.sparkContext.broadcast(look)  # bounded by capacities and groups

    @F.pandas_udf("long")
    def place(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for name, rest, ordinal in batches:
            out = np.zeros(len(name), dtype=np.int64)
            for n, (first, start, k, c0) in shared.value.items():
                mine = np.flatnonzero((name == n).to_numpy())
                if len(mine):
                    rank = rest.iloc[mine].map(first).to_numpy(np.int64) + ordinal.iloc[mine].to_numpy(np.int64)
                    row = np.searchsorted(start, rank, side="right") - 1
                    out[mine] = c0[row] + (rank - start[row]) // k[row]
            yield pd.Series(out)

    shape = ["size_name", "capacity", "container", F.col("_item").alias(item), "part", F.col("_here").alias(size)]
    placed = ranked(some, ["size_name", "capacity"], "_rest", "_item").withColumn("container", place("size_name", "_rest", "ordinal")).withColumn("part", F.col("_full").cast("int")).withColumn("_here", F.col("_rest"))
    # full containers of split items are numbered after the others: a running sum over salted parts
    split = every.filter("_full > 0").withColumn("_one", F.lit(0))
    salt = F.pmod(F.xxhash64("_item"), F.lit(64)).cast("int")
    split = split.withColumn("_salt", salt)
    inner = Window.partitionBy("size_name", "_salt").orderBy("_item").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("size_name").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offset = split.groupBy("size_name", "_salt").agg(F.sum("_full").alias("_s")).withColumn("_o", F.coalesce(F.sum("_s").over(outer), F.lit(0))).drop("_s")
    begin = F.lit(0).cast("long")
    for n, _ in caps:
        begin = F.when(F.col("size_name") == n, F.lit(used[n])).otherwise(begin)
    whole = (
        split.withColumn("_b", F.coalesce(F.sum("_full").over(inner), F.lit(0)))
        .join(offset, ["size_name", "_salt"])
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_full").cast("int") - 1)))
        .withColumn("container", begin + F.col("_o") + F.col("_b") + F.col("part"))
        .withColumn("_here", F.col("capacity"))
    )
    none = every.filter("_size = 0").withColumn("container", F.lit(None).cast("long")).withColumn("part", F.lit(0)).withColumn("_here", F.lit(0).cast("long"))
    return placed.select(shape).unionByName(whole.select(shape)).unionByName(none.select(shape))


def faults(packed: DataFrame, items: DataFrame, item: str = "doc_id", size: str = "tokens") -> DataFrame:
    """size_name, overfull (containers above their capacity), split (items in parts though they fit), lost (items of any size whose parts do not add up): all 0 if the packing is right."""
    full = packed.filter("container is not null").groupBy("size_name", "capacity", "container").agg(F.sum(size).alias("_s")).groupBy("size_name").agg(F.count(F.when(F.col("_s") > F.col("capacity"), 1)).alias("overfull"))
    per = packed.groupBy("size_name", "capacity", item).agg(F.sum(size).alias("_s"), F.count("*").alias("_n")).join(items.select(item, F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("_want")), item)
    per = per.groupBy("size_name").agg(F.count(F.when((F.col("_n") > 1) & (F.col("_want") <= F.col("capacity")), 1)).alias("split"), F.count(F.when(F.col("_s") != F.col("_want"), 1)).alias("wrong"), F.count("*").alias("_all"))
    total = F.broadcast(items.agg(F.count("*").alias("_items")))
    return per.join(total, F.lit(True)).join(full, "size_name", "left").select("size_name", F.coalesce("overfull", F.lit(0)).alias("overfull"), "split", (F.col("wrong") + F.abs(F.col("_items") - F.col("_all"))).alias("lost"))
