"""The authority file: attribute-value rows to records, links to canonical records, guarded replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Attributes that are not stored, languages by the end of a vocabulary's name, links that lead across languages, and types by file.
SKIPPED = ("LDMS URI", "VIAF URI", "Wikidata URI", "Source")
LANGUAGES = {"CN": "zh", "MY": "ms", "TM": "ta"}
CROSS = ("CHITOENG", "MAYTOENG", "TAMTOENG")
TYPES = {
    "PEOPLE": "PERSON", "ORGANISATIONS": "ORGANISATION", "GEOBUILDINGS": "FACILITY", "GEOGRAPHICS": "LOCATION", "EVENTS": "EVENT",
    "HISTORICAL_EVENTS": "EVENT", "AWARDS": "AWARD", "PROGRAMMES": "PROGRAMME", "LEGALACTS": "LEGAL_ACT",
}


def language_of(vocabulary: Column) -> Column:
    """The language a vocabulary's last part stands for, English otherwise."""
    end = F.upper(F.substring_index(vocabulary, "_", -1))
    out = F
    for k, v in LANGUAGES.items():
        out = out.when(end == k, v)
    return out.otherwise("en")


def family_of(vocabulary: Column) -> Column:
    """A vocabulary without the part that names its language."""
    return F.regexp_replace(vocabulary, "_(" + "|".join(LANGUAGES) + ")$", "")


def file_parts(filename: Column) -> Column:
    """Struct of entity_type and snapshot read from an export's file name; null where it is not a full export of a known vocabulary."""
    pattern = r"(?i)TTE-([A-Z_]+)_FULL_([0-9]{8})\.csv$"
    vocab, out = F.upper(F.regexp_extract(filename, pattern, 1)), F
    for k, v in TYPES.items():
        out = out.when(vocab == k, v)
    kind = out.otherwise(None)
    day = F.try_to_timestamp(F.regexp_extract(filename, pattern, 2), F.lit("yyyyMMdd")).cast("date")
    return F.when(kind.isNotNull() & day.isNotNull(), F.struct(kind.alias("entity_type"), day.alias("snapshot")))


def pivot_attributes(rows: DataFrame, by: str = "load_id") -> DataFrame:
    """by, uid, attribute, value: repeated values of an attribute joined by `` | `` in the order first seen (column ``pos``)."""
    r = rows.select(by, F.trim("key_uid").alias("uid"), F.trim("relationship_type").alias("attribute"), "pos", F.trim("related_descriptor").alias("v"), F.coalesce(F.trim("related_uid"), F.lit("")).alias("to"))
    r = r.filter((F.col("to") == "") & (F.col("v") != "") & (F.col("attribute") != "") & ~F.col("attribute").isin(*SKIPPED))
    first = r.groupBy(by, "uid", "attribute", "v").agg(F.min("pos").alias("pos"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda x: x["v"])
    return first.groupBy(by, "uid", "attribute").agg(F.array_join(listed, " | ").alias("value"))


def records(rows: DataFrame, by: str = "load_id") -> DataFrame:
    """by, uid, name, vocabulary, fields MAP: the first name and vocabulary win."""
    head = rows.groupBy(by, F.trim("key_uid").alias("uid")).agg(F.min_by("key_descriptor", "pos").alias("name"), F.min_by("key_vocabulary", "pos").alias("vocabulary"))
    fields = pivot_attributes(rows, by).groupBy(by, "uid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("attribute", "value")))).alias("fields"))
    return head.join(fields, [by, "uid"], "left")


def canonical_targets(rows: DataFrame, by: str = "load_id") -> DataFrame:
    """by, uid, canonical of every record: its smallest ``Use`` target, else itself; where that record is not English, the smallest target of its cross-language links instead.

    Links to oneself are none; types are compared without case and outer spaces. A preferred record that is not there is not followed further.
    """
    r = rows.select(by, F.trim("key_uid").alias("uid"), F.trim("key_vocabulary").alias("vocabulary"), "pos", F.upper(F.trim("relationship_type")).alias("t"), F.trim("related_uid").alias("to")).filter("uid <> ''")
    link = (F.col("to") != "") & (F.col("to") != F.col("uid"))
    per = r.groupBy(by, "uid").agg(
        F.min_by("vocabulary", "pos").alias("vocabulary"), F.min(F.when(link & (F.col("t") == "USE"), F.col("to"))).alias("use"), F.min(F.when(link & F.col("t").isin(*CROSS), F.col("to"))).alias("cross")
    )
    per = per.select(by, "uid", F.coalesce("use", "uid").alias("preferred"), "cross", language_of(F.coalesce("vocabulary", F.lit(""))).alias("language"))
    there = per.select(by, F.col("uid").alias("preferred"), F.col("cross").alias("_cross"), F.col("language").alias("_language"))
    return per.select(by, "uid", "preferred").join(there, [by, "preferred"], "left").select(by, "uid", F.when(F.col("_language") != "en", F.coalesce("_cross", "preferred")).otherwise(F.col("preferred")).alias("canonical"))


def missing_share(rows: DataFrame, loads: DataFrame, guard: float = 0.1) -> DataFrame:
    """volume, snapshot, held, missing, refused: records of the volume's previous snapshot that this one lacks, and whether that is above ``guard``. ``loads``: see ``snapshots.valid_loads``."""
    seen = rows.select("load_id", F.trim("key_uid").alias("uid")).filter("uid <> ''").join(loads, "load_id").select("volume", "idx", "uid").distinct()
    w = Window.partitionBy("volume", "uid").orderBy("idx")
    gone = seen.withColumn("next", F.lead("idx").over(w)).withColumn("lost", (F.coalesce("next", F.lit(-1)) != F.col("idx") + 1).cast("int"))
    per = gone.groupBy("volume", (F.col("idx") + 1).alias("idx")).agg(F.count("*").alias("held"), F.sum("lost").alias("missing"))
    days = loads.select("volume", "idx", "snapshot").distinct()
    return per.join(days, ["volume", "idx"]).select("volume", F.date_format("snapshot", "yyyy-MM-dd").alias("snapshot"), "held", "missing", (F.col("missing") > guard * F.col("held")).alias("refused"))
