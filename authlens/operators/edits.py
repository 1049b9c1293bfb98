"""Changes to a description: what a rewrite keeps, what it adds, and which sentences it edits."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import near_same, numbers_differ
from ..functions.text import sentences

# The share of a text a rewrite must keep, and the words a passage needs to count as a new fact unless it has a year.
KEPT, FACT_WORDS = 0.7, 4
YEAR = re.compile(r"\b(1[89]|20)\d{2}\b")

EDIT = "array<struct<at: int, upto: int, text: string>>"
CHANGE = "struct<verdict: string, kept: double, added: array<string>, pieces: array<struct<kind: string, text: string>>>"


def _is_fact(text: str) -> bool:
    return len(text.split()) >= FACT_WORDS or bool(YEAR.search(text))


def survives(old: str, new: str) -> float:
    """The characters of the old text found in the new one, in order, as a share of the old text; 1 for an empty old text."""
    if not old:
        return 1.0
    return sum(m.size for m in difflib.SequenceMatcher(None, old, new).get_matching_blocks()) / len(old)


def pieces(old: str, new: str) -> list[tuple[str, str]]:
    """The word-by-word difference in order: ``same``, ``out`` and ``in`` runs."""
    a, b = old.split(), new.split()
    out: list[tuple[str, str]] = []
    for op, i, j, k, m in difflib.SequenceMatcher(None, a, b).get_opcodes():
        if op == "equal":
            out.append(("same", " ".join(a[i:j])))
            continue
        out += [(kind, " ".join(w)) for kind, w in (("out", a[i:j]), ("in", b[k:m])) if w]
    return out


def judged(old: str | None, new: str | None) -> tuple[str, float, list[str], list[tuple[str, str]]]:
    """verdict (``keep``, ``drop`` a rewrite that adds no fact, ``flag`` one that keeps too little), share kept, passages added, pieces."""
    before, after = (old or "").strip(), (new or "").strip()
    parts = pieces(before, after)
    if not before:
        return "keep", 1.0, [after] if after else [], parts
    if before == after:
        return "drop", 1.0, [], parts
    added, kept = [t for kind, t in parts if kind == "in" and _is_fact(t)], survives(before, after)
    verdict = "drop" if not added else "keep" if kept >= KEPT else "flag"
    return verdict, kept, added, parts


def _carries(old: str, new: str) -> bool:
    """Whether a sentence keeps most words of another, in order."""
    a, b = (re.findall(r"\w+", s.casefold()) for s in (old, new))
    same = sum(m.size for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
    return not a or same >= KEPT * len(a)


def edits(before: list[str], after: list[str]) -> list[tuple[int, int, str]]:
    """A rewrite as edits of whole sentences: (at, upto, text) replaces sentence ``at`` where ``upto`` is one more, and goes in before it where both are equal.

    A new sentence that keeps most of an old one's words replaces that one if it adds a fact; any other new sentence with a fact goes in, and old ones stay.
    """
    held, out = set(before), []

    def insert(at: int, text: str) -> None:
        if text not in held and _is_fact(text):
            out.append((at, at, text))

    for op, i, j, k, m in difflib.SequenceMatcher(None, before, after, autojunk=False).get_opcodes():
        if op not in ("insert", "replace"):
            continue
        free = k
        for old in range(i, j):
            mate = next((x for x in range(free, m) if _carries(before[old], after[x])), None)
            if mate is None:
                continue
            for x in range(free, mate):
                insert(old, after[x])
            if any(kind == "in" and _is_fact(t) for kind, t in pieces(before[old], after[mate])):
                out.append((old, old + 1, after[mate]))
            free = mate + 1
        for x in range(free, m):
            insert(j, after[x])
    return out


def change(old: Column, new: Column) -> Column:
    """:func:`judged` of two columns as a struct."""

    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = [judged(x, y) for x, y in zip(a, b)]
        return pd.DataFrame([(v, k, x, [{"kind": c, "text": t} for c, t in p]) for v, k, x, p in rows], columns=["verdict", "kept", "added", "pieces"])

    return F.pandas_udf(run, CHANGE)(old, new)


def sentence_edits(old: Column, new: Column) -> Column:
    """:func:`edits` of two descriptions, sentences as ``functions.text.sentences`` parts them."""

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([[{"at": i, "upto": j, "text": t} for i, j, t in edits(list(x), list(y))] for x, y in zip(a, b)])

    return F.pandas_udf(run, EDIT)(sentences(old), sentences(new))


def best_quotes(changes: DataFrame, sentences_: DataFrame, least: float = 0.5, better: float = 0.2) -> DataFrame:
    """id, quote_id of changes (id, article_id, mention, name, tokens ARRAY, own ARRAY) for which another mention's sentence in the same article backs the change better than the mention's own.

    ``sentences_``: article_id, mention, said, tokens ARRAY. A sentence counts if it holds the name; it must have ``least`` of the change's tokens and ``better`` more than the own one. Of equals the smaller mention's stands.
    """
    s = sentences_.select("article_id", F.col("mention").alias("quote_id"), "said", F.col("tokens").alias("_t"))
    share = lambda t: F.size(F.array_intersect("tokens", t)) / F.size("tokens")
    x = changes.filter("size(tokens) > 0").join(s, "article_id").filter((F.col("quote_id") != F.col("mention")) & F.lower("said").contains(F.lower("name")))
    x = x.withColumn("_s", share("_t")).withColumn("_own", share("own")).filter((F.col("_s") >= least) & (F.col("_s") - F.col("_own") >= better))
    return x.groupBy("id").agg(F.max_by("quote_id", F.struct("_s", -F.col("quote_id"))).alias("quote_id"))


def rival_sentences(rows: DataFrame, group: str, key: str, text: str, source: str) -> DataFrame:
    """group, a, b, differ of pairs of sentences of one group from different sources that say one thing, and whether their numbers differ; groups are the sentences about one record."""
    x, y = rows.alias("x"), rows.alias("y")
    p = x.join(y, (F.col(f"x.{group}") == F.col(f"y.{group}")) & (F.col(f"x.{key}") < F.col(f"y.{key}")) & (F.col(f"x.{source}") != F.col(f"y.{source}")))
    a, b = F.col(f"x.{text}"), F.col(f"y.{text}")
    return p.filter(near_same(a, b)).select(F.col(f"x.{group}").alias(group), F.col(f"x.{key}").alias("a"), F.col(f"y.{key}").alias("b"), numbers_differ(a, b).alias("differ"))
