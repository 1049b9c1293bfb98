"""What changed between full snapshots that are delivered in volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def squeeze(c: Column | str) -> Column:
    """Outer and repeated spaces (U+0020 only) removed; null becomes the empty string."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.trim(F.regexp_replace(c, " +", " ")), F.lit(""))


def valid_loads(imports: DataFrame) -> DataFrame:
    """Loads that count, with the place of their snapshot within the volume.

    Loads whose ``rows_loaded`` is 0 or null are ignored; of several loads of one filename the one last loaded
    counts (a tie goes to the larger ``load_id``, a null ``loaded_at`` counts as earliest). Columns: load_id,
    volume, snapshot, idx (1 = the volume's first), next_snapshot (null on the last).
    """
    last = Window.partitionBy("filename").orderBy(F.col("loaded_at").desc_nulls_last(), F.col("load_id").desc())
    order = Window.partitionBy("volume").orderBy("snapshot")
    loads = (
        imports.filter(F.col("rows_loaded") > 0)
        .withColumn("_n", F.row_number().over(last))
        .filter("_n = 1")
        .select("load_id", "volume", "snapshot")
    )
    days = (
        loads.filter(F.col("snapshot").isNotNull())
        .select("volume", "snapshot")
        .distinct()
        .withColumn("idx", F.row_number().over(order))
        .withColumn("next_snapshot", F.lead("snapshot").over(order))
    )
    return loads.withColumnRenamed("volume", "_v").withColumnRenamed("snapshot", "_s").join(
        days, F.col("_v").eqNullSafe(F.col("volume")) & (F.col("_s") == F.col("snapshot"))
    ).drop("_v", "_s")


def snapshot_changes(rows: DataFrame, imports: DataFrame, key: str = "key_uid", ignore: Sequence[str] = ("load_id", "pos")) -> DataFrame:
    """Records added, removed or changed in a snapshot against the volume's previous snapshot there is.

    ``rows``: attribute-value rows with ``load_id``; ``imports``: the ledger (see :func:`valid_loads`). Content of a
    record is the set of its distinct rows over all columns but ``ignore``, spaces squeezed, null and empty alike;
    columns that ``rows`` has besides the export's own count as content. Rows with a null or blank key belong to no
    record. A volume's first snapshot gives no rows; empty tables give none.

    Every record keeps one 128-bit digest a snapshot: distinct rows first (partial aggregation, shuffled by record and
    row digest, so a record or link target with a third of all rows is spread), then a sum of digests, which is the
    same in any order. One window a record over its snapshots then yields changes (lag of the digest) and gaps.

    Returns volume, snapshot (STRING), uid, change.
    """
    content = [c for c in rows.columns if c not in ignore]
    flat = rows.select(F.col("load_id").alias("_load"), *[squeeze(F.col(c).cast("string")).alias(f"_c{i}") for i, c in enumerate(content)])
    uid = f"_c{content.index(key)}"
    digest = F.struct(*[F.col(f"_c{i}") for i in range(len(content))])
    flat = flat.filter(F.col(uid) != "").select(
        "_load", F.col(uid).alias("uid"), F.xxhash64(digest).alias("h1"), F.xxhash64(F.lit(7), F.reverse(F.to_json(digest))).alias("h2")
    )
    loads = valid_loads(imports)
    distinct = flat.join(loads, flat["_load"] == loads["load_id"]).select("volume", "idx", "snapshot", "next_snapshot", "uid", "h1", "h2").distinct()
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    state = distinct.groupBy("volume", "uid", "idx", "snapshot", "next_snapshot").agg(F.count("*").alias("n"), whole("h1").alias("s1"), whole("h2").alias("s2"))
    w = Window.partitionBy("volume", "uid").orderBy("idx")
    s = (
        state.withColumn("before", F.lag(F.struct("n", "s1", "s2")).over(w))
        .withColumn("prev", F.lag("idx").over(w))
        .withColumn("next", F.lead("idx").over(w))
    )
    kind = (
        F.when(F.col("prev") == F.col("idx") - 1, F.when(F.col("before") != F.struct("n", "s1", "s2"), "changed"))
        .when(F.col("idx") > 1, "added")
    )
    gone = F.when(F.col("next_snapshot").isNotNull() & (F.col("next").isNull() | (F.col("next") > F.col("idx") + 1)), F.col("next_snapshot"))
    event = F.array(F.struct(F.col("snapshot").alias("day"), kind.alias("change")), F.struct(gone.alias("day"), F.when(gone.isNotNull(), "removed").alias("change")))
    return (
        s.select("volume", "uid", F.explode(event).alias("e"))
        .filter("e.change is not null")
        .select("volume", F.date_format("e.day", "yyyy-MM-dd").alias("snapshot"), "uid", "e.change")
    )
