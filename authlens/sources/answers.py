"""Answers of a model: the JSON in a chat's text, and why an answer cannot be used."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_BLANK = " \t\r\n"


def _wide(c: str) -> bool:
    return bool(c) and any(a <= c <= b for a, b in (("　", "鿿"), ("豈", "﫿"), ("＀", "￯"), ("‘", "‟")))


def object_in(text: str | None) -> str | None:
    """The first JSON object in a text, with line breaks that a copy put into its strings mended; null where there is none or it does not end.

    One pass over the characters holds the depth of braces and whether a string is open. A break inside a string is a space, or nothing between two wide characters.
    """
    start = (text or "").find("{")
    if start < 0:
        return None
    out: list[str] = []
    i, depth, quoted, body = 0, 0, False, text[start:]
    while i < len(body):
        c = body[i]
        if quoted and c == "\\":
            out.append(body[i : i + 2])
            i += 2
            continue
        if quoted and c in _BLANK:
            end = i
            while end < len(body) and body[end] in _BLANK:
                end += 1
            if "\n" in body[i:end]:
                joined = _wide(out[-1][-1:] if out else "") and _wide(body[end : end + 1])
                out.append("" if joined else " ")
                i = end
                continue
        if c == '"':
            quoted = not quoted
        elif not quoted and c in "{}":
            depth += 1 if c == "{" else -1
        out.append(c)
        if depth == 0:
            return "".join(out)
        i += 1
    return None


@F.pandas_udf(StringType())
def json_object(text: pd.Series) -> pd.Series:
    """:func:`object_in` of a column."""
    return text.map(object_in)


@F.pandas_udf(StringType())
def answer_fault(text: pd.Series) -> pd.Series:
    """Why an answer that should list entities is none: ``empty``, ``prose``, ``cut off``, ``no entities``, ``lacks summary or evidence``; an empty string for a good one. Code fences are taken off; a bare list counts as the list of entities."""

    def fault(cell: str | None) -> str:
        raw = (cell or "").strip()
        if raw.startswith("```"):
            raw = raw[3:].removeprefix("json").lstrip()
        raw = raw.removesuffix("```").rstrip()
        if not raw:
            return "empty"
        try:
            got = json.loads(raw)
        except ValueError:
            return "cut off" if raw[0] in "{[" else "prose"
        rows = got if isinstance(got, list) else got.get("entities") if isinstance(got, dict) else None
        if not isinstance(rows, list):
            return "no entities"
        whole = all(isinstance(e, dict) and e.get("summary") and e.get("evidence") for e in rows)
        return "" if whole else "lacks summary or evidence"

    return text.map(fault)


def verdicts(batch: DataFrame, answers: DataFrame) -> DataFrame:
    """id, relevant, reason of every row of a batch (id) from answers that name only the relevant ones (id, reason); answers for other ids count nothing, of repeated ones the smallest reason stands."""
    a = answers.groupBy("id").agg(F.min("reason").alias("reason")).withColumn("_in", F.lit(True))
    return batch.select("id").distinct().join(a, "id", "left").select("id", F.coalesce("_in", F.lit(False)).alias("relevant"), "reason")


def first_answers(answers: DataFrame, mentions: DataFrame) -> DataFrame:
    """Answers (article_id, name, at: place in the answer, action, uid, offered ARRAY) held against the mentions (id, article_id, entity_name, entity_name_en): id, action, uid of every mention.

    An answer belongs to the first mention of its article of that name, or else of that English name; the first answer to a mention counts, a match that was not offered counts as none, and a mention without an answer is new.
    """
    named = mentions.select("article_id", F.col("entity_name").alias("name"), F.struct(F.lit(0).alias("p"), "id").alias("k")).unionByName(mentions.select("article_id", F.col("entity_name_en").alias("name"), F.struct(F.lit(1).alias("p"), "id").alias("k")))
    named = named.filter("name is not null").groupBy("article_id", "name").agg(F.min(F.struct(F.col("k.id").alias("i"), F.col("k.p").alias("p"))).alias("m"))
    ok = F.col("uid").isNull() | F.coalesce(F.array_contains("offered", F.col("uid")), F.lit(False))
    x = answers.join(named, ["article_id", "name"]).filter(ok & (F.col("action") != "CREATE_NEW")).select(F.col("m.i").alias("id"), "at", "action", "uid")
    first = x.groupBy("id").agg(F.min_by(F.struct("action", "uid"), "at").alias("m"))
    return mentions.select("id").distinct().join(first, "id", "left").select("id", F.coalesce("m.action", F.lit("CREATE_NEW")).alias("action"), F.col("m.uid").alias("uid"))


def split_fields(line: Column) -> Column:
    """``Key: value · Key: value`` as an array of key and value, parted only before a key; a part without a key has an empty one."""
    parts = F.filter(F.split(F.trim(F.coalesce(line, F.lit(""))), r"\s·\s(?=[A-Z][^:·]{0,60}: )"), lambda p: F.trim(p) != "")
    key = lambda p: F.when(p.contains(": "), F.trim(F.substring_index(p, ": ", 1))).otherwise("")
    value = lambda p: F.when(p.contains(": "), F.trim(F.substring(p, F.instr(p, ": ") + 2, F.length(p)))).otherwise(F.trim(p))
    return F.transform(parts, lambda p: F.struct(key(p).alias("key"), value(p).alias("value")))


def one_line(c: Column, most: int = 140) -> Column:
    """The first line that is not blank, without quotes around it; empty if it is longer than ``most``."""
    first = F.coalesce(F.get(F.filter(F.transform(F.split(c, r"\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: x != ""), F.lit(0)), F.lit(""))
    bare = F.regexp_replace(first, "^[ \"“”']+|[ \"“”']+$", "")
    return F.when(F.length(bare) <= most, bare).otherwise("")
