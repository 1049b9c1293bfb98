"""Exports of the authority file: CSV files of attribute-value rows, alone or in archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.authority import file_parts

# Fixed value: an export's columns and what they are called here.
COLUMNS = {
    "Key UID": "key_uid", "Key Descriptor": "key_descriptor", "Key Vocabulary": "key_vocabulary", "Relationship Type": "relationship_type",
    "Related UID": "related_uid", "Related Descriptor": "related_descriptor", "Related Vocabulary": "related_vocabulary",
}


def read_exports(spark: SparkSession, path: str) -> DataFrame:
    """filename, entity_type, snapshot, pos and the export's columns of all CSV files under ``path`` whose name is a full export of a known vocabulary; other files give no rows.

    Columns are found by their header, a byte order mark aside; a missing one is null. ``pos`` grows in the order of a file's rows.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("pathGlobFilter", "*.csv").csv(path)
    at = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    named = {c.lstrip("﻿").strip(): c for c in raw.columns}
    cols = [(F.col(f"`{named[k]}`") if k in named else F.lit(None).cast("string")).alias(v) for k, v in COLUMNS.items()]
    x = raw.select(at.alias("filename"), F.monotonically_increasing_id().alias("pos"), *cols).withColumn("_p", file_parts(F.col("filename")))
    return x.filter("_p is not null").select("filename", "_p.entity_type", "_p.snapshot", "pos", *COLUMNS.values())


def expand_archives(spark: SparkSession, path: str) -> DataFrame:
    """archive, filename, kind (``export``, ``deletes``, ``skipped``), content of the files in zip archives under ``path``, those in archives within them included. ``deletes`` are CSV files whose name says so; only what is used has its content. A broken archive is one skipped row."""

    def members(name: str, data: bytes, depth: int = 0) -> Iterator[tuple[str, bytes | None]]:
        try:
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                for m in z.namelist():
                    if m.endswith("/"):
                        continue
                    if m.lower().endswith(".zip") and depth == 0:
                        yield from members(m, z.read(m), 1)
                    else:
                        yield m.rpartition("/")[2], z.read(m) if m.lower().endswith(".csv") else None
        except zipfile.BadZipFile:
            yield name, None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p, n, c.decode("utf-8-sig", "replace") if c is not None else None) for p, data in zip(b.path, b.content) for n, c in members(p.rpartition("/")[2], data)]
            yield pd.DataFrame(rows, columns=["archive", "filename", "content"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    x = files.mapInPandas(read, "archive string, filename string, content string")
    kind = F.when(file_parts(F.col("filename")).isNotNull() & F.col("content").isNotNull(), "export").when(F.lower("filename").contains("delete") & F.col("content").isNotNull(), "deletes").otherwise("skipped")
    x = x.withColumn("kind", kind)
    return x.select(F.substring_index("archive", "/", -1).alias("archive"), "filename", "kind", F.when(F.col("kind") != "skipped", F.col("content")).alias("content"))


def delete_list(archives: DataFrame) -> DataFrame:
    """uid: all first columns of the delete lists, their headers aside."""
    lines = archives.filter("kind = 'deletes'").select(F.posexplode(F.split("content", r"\r?\n")).alias("at", "line")).filter("at > 0")
    return lines.select(F.trim(F.regexp_replace(F.substring_index("line", ",", 1), '"', "")).alias("uid")).filter("uid <> ''").distinct()
