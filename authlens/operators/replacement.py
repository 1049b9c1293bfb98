"""Replacing the stored authority records by a new snapshot, and what the replacement puts back in the queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .authority import CROSS, canonical_targets, family_of, language_of, pivot_attributes

#: A snapshot that silently lacks more than this share of the records it covers is refused.
MOST_MISSING = 0.10
#: What the newest load has seen within so many hours belongs to one import.
IMPORT_HOURS = 6


def snapshot_records(rows: DataFrame, by: str = "load_id") -> DataFrame:
    """by, uid, name, vocabulary, language, canonical_uid (null on a preferred record), fields MAP of every record of each load.

    The first row of a record gives its name and vocabulary; rows without a uid or name are no record's.
    """
    r = rows.withColumn("_uid", F.trim("key_uid")).withColumn("_name", F.trim("key_descriptor")).filter("_uid <> '' and _name <> ''")
    head = r.groupBy(by, F.col("_uid").alias("uid")).agg(F.min_by("_name", "pos").alias("name"), F.min_by(F.coalesce(F.trim("key_vocabulary"), F.lit("")), "pos").alias("vocabulary"))
    fields = pivot_attributes(r, by).groupBy(by, "uid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("attribute", "value")))).alias("fields"))
    canon = canonical_targets(r, by).select(by, "uid", F.when(F.col("canonical") != F.col("uid"), F.col("canonical")).alias("canonical_uid"))
    out = head.join(canon, [by, "uid"], "left").join(fields, [by, "uid"], "left")
    return out.select(by, "uid", "name", "vocabulary", language_of(F.col("vocabulary")).alias("language"), "canonical_uid", F.coalesce("fields", F.create_map().cast("map<string,string>")).alias("fields"))


def changed(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``new`` that ``stored`` lacks, holds as inactive or holds otherwise in name, vocabulary, language, canonical_uid or fields (compared as sorted entries)."""
    entries = lambda c: F.array_sort(F.map_entries(c))
    s = stored.select("uid", F.col("is_active").alias("_active"), *[F.col(c).alias(f"_{c}") for c in ("name", "vocabulary", "language", "canonical_uid")], entries("fields").alias("_fields"))
    x = new.join(s, "uid", "left")
    same = F.col("_active")
    for c in ("name", "vocabulary", "language", "canonical_uid"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return x.filter(~F.coalesce(same & entries("fields").eqNullSafe(F.col("_fields")), F.lit(False))).select(new.columns)


def dropped(new: DataFrame, stored: DataFrame, deletes: DataFrame | None = None) -> DataFrame:
    """uid, is_active, family, listed of stored records that the snapshot lacks: those of the vocabulary families it covers, and those listed for deletion (``deletes``: uid)."""
    families = new.select(family_of(F.col("vocabulary")).alias("family")).distinct().withColumn("_covered", F.lit(True))
    gone = stored.withColumn("family", family_of(F.col("vocabulary"))).join(new.select("uid"), "uid", "left_anti").join(F.broadcast(families), "family", "left")
    if deletes is None:
        gone = gone.withColumn("listed", F.lit(False))
    else:
        gone = gone.join(deletes.select("uid").distinct().withColumn("_listed", F.lit(True)), "uid", "left").withColumn("listed", F.coalesce("_listed", F.lit(False)))
    return gone.filter(F.coalesce("_covered", F.lit(False)) | F.col("listed")).select("uid", "is_active", "family", "listed", "canonical_uid")


def refusal(new: DataFrame, stored: DataFrame, gone: DataFrame) -> DataFrame:
    """One row: active (stored records covered), silent (of them dropped unlisted), refused."""
    families = new.select(family_of(F.col("vocabulary")).alias("family")).distinct()
    active = stored.filter("is_active").withColumn("family", family_of(F.col("vocabulary"))).join(F.broadcast(families), "family", "left_semi").agg(F.count("*").alias("active"))
    silent = gone.filter("is_active and not listed").agg(F.count("*").alias("silent"))
    return active.join(silent, F.lit(True)).withColumn("refused", (F.col("active") > 0) & (F.col("silent") > MOST_MISSING * F.col("active")))


def removal(gone: DataFrame, new: DataFrame, stored: DataFrame, matched: DataFrame) -> DataFrame:
    """uid, action of dropped records: ``keep`` (as inactive) while a match (``matched``: uid) or a record that stays points there, else ``delete``."""
    stays = stored.join(new.select("uid"), "uid", "left_anti").join(gone.select("uid"), "uid", "left_anti")
    held = matched.select("uid").unionByName(new.select(F.col("canonical_uid").alias("uid"))).unionByName(stays.select(F.col("canonical_uid").alias("uid"))).filter("uid is not null").distinct()
    return gone.select("uid").join(held.withColumn("_held", F.lit(True)), "uid", "left").select("uid", F.when(F.col("_held"), "keep").otherwise("delete").alias("action"))


def passes(new: DataFrame, stored: DataFrame) -> DataFrame:
    """uid, pass, pointer of the records written: a pointer to a record that is new itself waits for a second pass."""
    fresh = new.select("uid").join(stored.select("uid"), "uid", "left_anti").select(F.col("uid").alias("canonical_uid"), F.lit(True).alias("_new"))
    x = new.join(fresh, "canonical_uid", "left")
    first = x.select("uid", F.lit(1).alias("pass"), F.when(F.col("_new").isNull(), F.col("canonical_uid")).alias("pointer"))
    return first.unionByName(x.filter("_new").select("uid", F.lit(2).alias("pass"), F.col("canonical_uid").alias("pointer")))


def last_import(records: DataFrame) -> DataFrame:
    """uid, state (``added`` by the newest import, ``retired``) of the records the newest import concerns; a retired record counts as retired."""
    newest = records.agg(F.max("last_seen").alias("_newest"))
    x = records.join(F.broadcast(newest), F.lit(True))
    added = F.unix_micros("first_seen") > F.unix_micros("_newest") - IMPORT_HOURS * 3_600_000_000
    return x.select("uid", F.when(~F.col("is_active"), "retired").when(added, "added").alias("state")).filter("state is not null")


def stale(mentions: DataFrame, matches: DataFrame, candidates: DataFrame, imported: DataFrame) -> DataFrame:
    """id, why of mentions whose decision the import may have changed: the matched record is retired, or a record added is now a candidate.

    ``matches``: id, uid; ``candidates``: id, uid (see ``retrieval.top_candidates``); ``imported``: see :func:`last_import`.
    """
    retired = matches.join(imported.filter("state = 'retired'"), "uid", "left_semi").select("id").distinct().withColumn("why", F.lit("matched record retired"))
    fresh = candidates.join(imported.filter("state = 'added'"), "uid", "left_semi").select("id").distinct().withColumn("why", F.lit("a new record is now a candidate"))
    return mentions.select("id").distinct().join(retired.unionByName(fresh.join(retired.select("id"), "id", "left_anti")), "id")


def requeued(mentions: DataFrame, matches: DataFrame, again: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mentions with ``resolved`` cleared and the matches without those of the mentions in ``again`` (id)."""
    ids = again.select("id").distinct().withColumn("_again", F.lit(True))
    m = mentions.join(ids, "id", "left").withColumn("resolved", F.col("resolved") & F.col("_again").isNull()).drop("_again")
    return m, matches.join(ids.select(F.col("id").alias("extracted_id")), "extracted_id", "left_anti")


__all__ = ["CROSS", "changed", "dropped", "last_import", "passes", "refusal", "removal", "requeued", "snapshot_records", "stale"]
