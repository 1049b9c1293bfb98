"""Proposed changes into cards, and the leased review queue."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def proposed_changes(matches: DataFrame) -> DataFrame:
    """id, uid, extracted_id, field, strategy, value: one row a proposed field update; repeated decisions are one."""
    m = matches.filter("matched_uid is not null").select("id", F.col("matched_uid").alias("uid"), "extracted_id", F.explode("field_updates").alias("u"))
    return m.select("id", "uid", "extracted_id", "u.field", "u.strategy", "u.value").distinct()


def collapse(changes: DataFrame) -> DataFrame:
    """uid, field, strategy, value (longest wording, ties by text), values, sources, conflict (a scalar replaced by different values)."""
    v = F.lower(F.trim("value"))
    longest = F.max_by("value", F.struct(F.length("value"), "value"))
    return changes.groupBy("uid", "field", "strategy").agg(
        longest.alias("value"), F.countDistinct(v).alias("values"), F.countDistinct("extracted_id").alias("sources"),
        ((F.first("strategy") == "OVERWRITE") & (F.countDistinct(v) > 1)).alias("conflict"),
    )


def field_delta(changes: DataFrame, records: DataFrame) -> DataFrame:
    """uid, field, state, n: proposed values against what the record holds: ``new`` (no such field), ``same``, ``extra`` (another value)."""
    held = records.select("uid", F.explode("fields").alias("field", "held"))
    x = changes.join(held, ["uid", "field"], "left")
    parts = F.transform(F.split(F.lower("held"), r"\|"), lambda p: F.trim(p))
    state = F.when(F.col("held").isNull(), "new").when(F.array_contains(parts, F.lower(F.trim("value"))), "same").otherwise("extra")
    return x.groupBy("uid", "field", state.alias("state")).agg(F.count("*").alias("n"))


def account_for(proposed: DataFrame, shown: DataFrame) -> DataFrame:
    """uid, field, value proposed (any strategy) but shown under no wording: the reconciliation, empty if nothing was lost."""
    key = [F.col("uid"), F.col("field"), F.lower(F.trim("value")).alias("value")]
    return proposed.select(*key).distinct().join(shown.select(*key).distinct(), ["uid", "field", "value"], "left_anti")


def leases(events: DataFrame, minutes: int = 60) -> DataFrame:
    """user_id, lease, started, ended, events: a lease lives while each event comes within ``minutes`` of the one before."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    gap = at - F.lag(at).over(w) > minutes * 60_000_000
    e = events.withColumn("_new", F.coalesce(gap, F.lit(True)).cast("int")).withColumn("lease", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return e.groupBy("user_id", "lease").agg(F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count("*").alias("events"))


def replay(commands: DataFrame, minutes: int = 60) -> DataFrame:
    """Replays take, renew, release and decide commands on each card in order: card, user, verdict, at, outcome.

    ``commands``: card, seq, user, verb (view = take, click = renew, error = release, purchase = decide), ts. A card's commands form one state; only the holder may renew,
    release or decide, a lease ends ``minutes`` after its last renewal, and the first decision stands.
    """

    ordered = commands.repartition("card").sortWithinPartitions("card", "ts", "seq")

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # commands of a card are neighbours; state of one card at a time is held, however many commands it has
        state: dict = {}
        for b in batches:
            rows = []
            for card, seq, user, verb, ts in b[["card", "seq", "user", "verb", "ts"]].itertuples(index=False, name=None):
                if card not in state:
                    state.clear()
                    state[card] = (None, None, False)
                holder, until, decided = state[card]
                live = holder is not None and ts < until
                if verb == "view":
                    ok = not decided and (not live or holder == user)
                    if ok:
                        holder, until = user, ts + pd.Timedelta(minutes=minutes)
                else:
                    ok = bool(live and holder == user and not decided)
                    if ok and verb == "click":
                        until = ts + pd.Timedelta(minutes=minutes)
                    elif ok:
                        decided, holder = verb == "purchase", None
                state[card] = (holder, until, decided)
                rows.append((card, seq, user, verb, bool(ok)))
            yield pd.DataFrame(rows, columns=["card", "seq", "user", "verb", "done"])

    return ordered.mapInPandas(stream, "card long, seq long, user long, verb string, done boolean")
