"""Intermediate tables in the folder all executors share.

Iterative operators cut lineage by writing a Parquet table and reading it back, which survives the loss of an
executor and gives the planner true sizes. The folder is the session's ``spark.checkpoint.dir``; only where that
is unset on a local master (tests, a laptop) a local one is made; on a cluster that is an error, as executors would
write to disks that the others cannot read.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
#: Folders of the operators run so far, which :func:`clean` removes.
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, or one of our own where the session names none."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="authlens-")
        atexit.register(shutil.rmtree, _own[app], True)
    return "file://" + _own[app]


class Scratch:
    """Tables of one operator run. ``keep`` writes and reads back; ``drop`` deletes tables no longer read."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/authlens/{name}-{uuid.uuid4().hex[:12]}"
        _made.append(self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        _delete(self.spark, self.path(name))

    def release(self) -> None:
        """Lets go of the shuffle files of jobs that have ended, which Spark keeps until the driver collects its garbage."""
        self.spark._jvm.System.gc()


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, name: str) -> None:
    path, system = _path(spark, name)
    system.delete(path, True)


def exists(spark: SparkSession, name: str) -> bool:
    path, system = _path(spark, name)
    return system.exists(path)


def clean(spark: SparkSession) -> None:
    """Removes the tables of all operators run so far. Results that were not yet written or collected read them, so call it after."""
    while _made:
        _delete(spark, _made.pop())
