"""Incremental ingest: each url once, for ever, over restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import exists


def ingest_once(spark: SparkSession, path: str, place: str, key: str = "url", order: tuple[str, ...] = ("created_at", "id")) -> DataFrame:
    """Takes in what has come to ``path`` since the last call and returns all rows held: the first row of each ``key`` in ``order``; rows with a null key are left out.

    ``place`` is a folder the caller names and keeps: the stream's progress and the rows lie there, so a second call reads only new files. A key that any earlier batch holds is not taken again, however
    late it comes; the state is the table itself, not a window of time. A batch is written under its number, so one that is repeated after a failure replaces itself.
    """
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    single = name.endswith(".parquet") and not _is_dir(spark, path)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder) if single else spark.readStream.schema(schema).parquet(path)
    rows = f"{place}/rows"

    def take(batch: DataFrame, number: int) -> None:
        first = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
        fresh = batch.filter(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
        if exists(spark, rows):
            held = spark.read.parquet(rows).filter(F.col("batch") != number)
            fresh = fresh.join(held.select(key), key, "left_anti").select(batch.columns)
        fresh.write.mode("overwrite").parquet(f"{rows}/batch={number}")

    stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{place}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(rows) if exists(spark, rows) else spark.createDataFrame([], schema)


def _is_dir(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
