"""Tables in parts of bounded size, and what earlier parts already hold."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.cards import ordered_positions
from ..scratch import Scratch

#: Rows of one part, and bytes of one part of an import.
ROWS, BYTES = 50_000, 6_000_000


def first_of_each(rows: DataFrame, order: list[Column], key: str = "url") -> DataFrame:
    """The first row of each key in an order that tells all rows of a key apart; null keys are none."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.filter(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def with_parts(rows: DataFrame, by: str, order: list[Column], limit: int = ROWS) -> DataFrame:
    """Adds part (from 1) and at (from 0 in the part): rows of each ``by`` in order, ``limit`` a part.

    Rows are placed in the whole order by ranges (see ``cards.ordered_positions``), so a group of a third of all rows is not one task's.
    """
    x = ordered_positions(rows, [F.col(by), *order], "_at")
    first = x.groupBy(by).agg(F.min("_at").alias("_first"))
    x = x.join(first, by).withColumn("_k", F.col("_at") - F.col("_first"))
    return x.withColumn("part", (F.floor(F.col("_k") / limit) + 1).cast("int")).withColumn("at", (F.col("_k") % limit).cast("int")).drop("_at", "_first", "_k")


def byte_parts(rows: DataFrame, size: str, order: list[Column], most: int = BYTES) -> DataFrame:
    """Adds part (from 1): rows in order, filled into parts of at most ``most`` bytes (column ``size``); a row larger than that is a part of its own.

    Each range of the order fills its own parts one after the other, and numbers go on over the ranges, so at most one part a range is not full.
    """
    tmp = Scratch(rows.sparkSession, "parts")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    at = rows.columns.index(size)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        piece, used, count, where = 0, 0, 0, TaskContext.get().partitionId()
        for b in batches:
            pieces = []
            for s in b.iloc[:, at]:
                if count and used + s > most:
                    piece, used, count = piece + 1, 0, 0
                used, count = used + s, count + 1
                pieces.append(piece)
            yield b.assign(_range=where, _piece=pieces)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = tmp.keep(x.mapInPandas(fill, f"{fields}, _range int, _piece int"), "placed")
    per = placed.groupBy("_range").agg((F.max("_piece") + 1).alias("_k"))
    before = per.select("_range", F.coalesce(F.sum("_k").over(Window.partitionBy(F.lit(1)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return placed.join(F.broadcast(before), "_range").withColumn("part", (F.col("_b") + F.col("_piece") + 1).cast("int")).drop("_range", "_piece", "_b")


def write_parts(rows: DataFrame, path: str, limit: int = ROWS) -> None:
    """Appends rows to CSV files of at most ``limit`` rows."""
    rows.write.mode("append").option("header", True).option("maxRecordsPerFile", limit).csv(path)


def not_held(rows: DataFrame, held: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose key is not in ``held``, so that a run goes on where an earlier one stopped."""
    return rows.join(held.select(key).distinct(), key, "left_anti")


def last_line(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of several lines of one key the last in order."""
    others = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("m"))
    return best.select(key, *[F.col("m")[c].alias(c) for c in others])


def batched(rows: DataFrame, key: str, size: int, seed: str = "1") -> DataFrame:
    """Adds batch (from 0): rows in the order of a seeded digest of the key, ``size`` a batch."""
    order = [F.md5(F.concat(F.lit(seed + ":"), F.col(key).cast("string"))), F.col(key)]
    return ordered_positions(rows, order, "_at").withColumn("batch", F.floor(F.col("_at") / size).cast("int")).drop("_at")
