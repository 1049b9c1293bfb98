"""Field names and closed vocabularies of the authority file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .names import DELIMITER, values

# The fields each type of record may hold, and the fields whose values come from a closed list.
FIELDS: dict[str, tuple[str, ...]] = {
    "PERSON": (
        "Name", "Description", "Title", "Occupation", "Nationality", "Place of Birth", "Birth Year (yyyy)", "Birth Month (mm)", "Birth Day (dd)",
        "Death Year (yyyy)", "Death Month (mm)", "Death Day (dd)", "Active Years", "Achievements", "Education", "Awards",
        "Affiliations(groupName)", "Spouse", "Child", "Parent",
    ),
    "ORGANISATION": (
        "Name", "Description", "Country", "Street Address", "Postal Code", "Founder", "Year Started (yyyy)", "Month Started (mm)", "Day Started (dd)",
        "Year Ended (yyyy)", "Month Ended (mm)", "Day Ended (dd)", "Parent Organisation", "Group Members", "Awards",
    ),
    "FACILITY": (
        "Name", "Description", "Street Address", "Country", "Postal Code", "Feature Type", "Year Completed (yyyy)", "Month Completed (mm)", "Day Completed (dd)",
    ),
    "LOCATION": ("Name", "Description", "Country", "Feature Type", "Street Address", "Postal Code"),
    "EVENT": ("Name", "Description", "SN", "Organiser", "Year", "Month", "Day", "Category", "Slogan"),
    "AWARD": ("Name", "SN", "Awarding Entity", "Year First Awarded"),
    "PROGRAMME": ("Name", "Description"),
    "LEGAL_ACT": ("Name", "SN"),
}
CONSTRAINED = ("Occupation", "Nationality", "Title", "Feature Type", "Category")


def bare(c: Column) -> Column:
    """A field name as a reader is likely to get it right: without brackets, case and anything but letters."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"\s*\([^)]*\)", "")), "[^a-z]", "")


def stored_names(spark: SparkSession) -> DataFrame:
    """kind, bare, stored: a fixed table of under a hundred rows."""
    t = spark.createDataFrame([(k, f) for k, fs in FIELDS.items() for f in fs], "kind string, stored string")
    return t.select("kind", bare(F.col("stored")).alias("bare"), "stored")


def with_stored(df: DataFrame, kind: str, field: str) -> DataFrame:
    """Adds ``stored``: the field's name as stored for the type, null where there is none."""
    t = stored_names(df.sparkSession).select(F.col("kind").alias("_kind"), F.col("bare").alias("_bare"), "stored")
    return df.join(F.broadcast(t), (F.col(kind) == F.col("_kind")) & (bare(F.col(field)) == F.col("_bare")), "left").drop("_kind", "_bare")


def clean_fields(rows: DataFrame, allowed: DataFrame, key: str = "id", kind: str = "kind", fields: str = "fields") -> DataFrame:
    """key, kept MAP, dropped ARRAY: fields under their stored names; of fields with a closed list only the listed entries.

    ``allowed``: field, term of the closed lists; a field of which it has no term keeps its values. Of several names of one stored field the last in order of the written names stands.
    ``dropped`` has the names that are no field of the type and ``field=value`` where no entry is listed, sorted. Null values are dropped; rows without fields come out with an empty map.
    """
    x = with_stored(rows.select(key, kind, F.posexplode(F.sort_array(F.map_entries(fields))).alias("at", "e")).select(key, kind, "at", "e.key", "e.value"), kind, "key")
    # a column of values is exploded and put together again only for fields with a list
    lists = allowed.select(F.col("field").alias("stored"), F.col("term")).distinct()
    closed = [r["stored"] for r in lists.filter(F.col("stored").isin(*CONSTRAINED)).select("stored").distinct().collect()]
    free = x.filter(F.col("stored").isNull() | ~F.col("stored").isin(*closed)).select(key, "at", "key", "stored", "value", F.when(F.col("stored").isNotNull(), F.col("value")).alias("clean"))
    parts = x.filter(F.col("stored").isin(*closed)).select(key, "at", "key", "stored", "value", F.posexplode_outer(values(F.col("value"))).alias("i", "term"))
    hit = parts.join(lists.withColumn("_ok", F.lit(True)), ["stored", "term"], "left")
    listed = hit.groupBy(key, "at", "key", "stored", "value").agg(F.array_sort(F.collect_list(F.when(F.col("_ok"), F.struct("i", "term")))).alias("kept"))
    listed = listed.select(key, "at", "key", "stored", "value", F.nullif(F.array_join(F.transform("kept", lambda s: s["term"]), DELIMITER), F.lit("")).alias("clean"))
    out = free.unionByName(listed).withColumn("lost", F.when(F.col("stored").isNull(), F.col("key")).when(F.col("clean").isNull(), F.concat("stored", F.lit("="), F.coalesce("value", F.lit("")))))
    last = out.filter("clean is not null").groupBy(key, "stored").agg(F.max_by("clean", "at").alias("clean"))
    kept = last.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("stored", "clean")))).alias("kept"))
    dropped = out.filter("lost is not null").groupBy(key).agg(F.array_sort(F.collect_list("lost")).alias("dropped"))
    none = F.create_map().cast("map<string,string>")
    return rows.select(key).distinct().join(kept, key, "left").join(dropped, key, "left").select(key, F.coalesce("kept", none).alias("kept"), F.coalesce("dropped", F.array().cast("array<string>")).alias("dropped"))
