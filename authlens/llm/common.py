"""Helpers of the operators in this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Enough partitions for CPU-bound Python work. Tables whose estimated size gives each core two splits of a scan have them already; smaller ones are shuffled. Only the planner's estimate of the tables is read, nothing runs."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return df.repartition(4 * cores, *cols) if size < 2 * cores * split else df
