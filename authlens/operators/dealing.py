"""Replaying the commands of the review desk: who is dealt which card, and which decisions stand."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Minutes a card is held after it was taken or renewed.
HOLD = 60
VERDICTS = ("approve", "reject", "unsure")
OUT = "desk string, seq long, who long, verb string, card string, done boolean"


class Desk:
    """The state of one desk: cards in queue order, who holds which, and the decision on each proposal."""

    def __init__(self) -> None:
        self.order: list[str] = []
        self.pids: dict[str, list[int]] = {}
        self.holds: dict[str, tuple[int, object]] = {}
        self.said: dict[int, dict] = {}
        self.start = 0

    def live(self, card: str, now) -> int | None:
        who, until = self.holds.get(card, (None, None))
        return who if until is not None and now < until else None

    def settled(self, card: str) -> bool:
        return all(p in self.said and self.said[p]["verdict"] != "unsure" for p in self.pids[card])

    def open_to(self, card: str, who: int) -> bool:
        """A proposal undecided, or left unsure by another and not kept by this reviewer."""
        return any(p not in self.said or (self.said[p]["verdict"] == "unsure" and self.said[p]["who"] != who and who not in self.said[p]["kept"]) for p in self.pids[card])

    def give_back(self, who: int, but: str | None = None) -> None:
        for c in [c for c, (w, _) in self.holds.items() if w == who and c != but]:
            del self.holds[c]

    def take(self, who: int, now) -> str | None:
        """The next open card that nobody holds; the reviewer's own earlier hold ends first. Settled cards at the head of the queue are passed for good."""
        self.give_back(who)
        while self.start < len(self.order) and self.settled(self.order[self.start]):
            self.start += 1
        for card in self.order[self.start :]:
            if self.live(card, now) is None and not self.settled(card) and self.open_to(card, who):
                self.holds[card] = (who, now + pd.Timedelta(minutes=HOLD))
                return card
        return None

    def claim(self, card: str, who: int, now) -> bool:
        mine = any(self.said.get(p, {}).get("who") == who for p in self.pids.get(card, ()))
        if card not in self.pids or not (self.open_to(card, who) or mine):
            return False
        self.give_back(who, card)
        if self.live(card, now) in (None, who):
            self.holds[card] = (who, now + pd.Timedelta(minutes=HOLD))
        return self.live(card, now) == who

    def renew(self, card: str, who: int, now) -> bool:
        if self.holds.get(card, (None, None))[0] != who:
            return False
        self.holds[card] = (who, now + pd.Timedelta(minutes=HOLD))
        return True

    def release(self, card: str, who: int) -> bool:
        held = self.holds.get(card, (None, None))[0] == who
        if held:
            del self.holds[card]
        return held

    def decide(self, card: str, who: int, pid: int, verdict: str) -> bool:
        """The holder's verdict on one of the card's proposals: new, their own until marked done, or taken over from another's unsure that they have not kept themselves."""
        if self.holds.get(card, (None, None))[0] != who or pid not in self.pids.get(card, ()) or verdict not in VERDICTS:
            return False
        old = self.said.get(pid)
        if old and not ((old["who"] == who and not old["done"]) or (old["verdict"] == "unsure" and who not in old["kept"])):
            return False
        kept = list(old["kept"]) if old else []
        if verdict == "unsure" and who not in kept:
            kept.append(who)
        self.said[pid] = {"who": who, "verdict": verdict, "kept": kept, "done": bool(old and old["who"] == who and old["done"])}
        return True

    def mark_done(self, who: int, pid: int, done: bool = True) -> bool:
        if self.said.get(pid, {}).get("who") != who:
            return False
        self.said[pid]["done"] = done
        return True


def replay_desks(cards: DataFrame, commands: DataFrame) -> DataFrame:
    """desk, seq, who, verb, card, done: every command's outcome, in the order of (ts, seq) at each desk.

    ``cards``: desk, ord, card, pids ARRAY; ``commands``: desk, seq, ts, who, verb (take, claim, renew, release, decide, done), card, pid, verdict. Leases are exclusive, so a desk's commands are one
    sequence and run in one task; a desk is a pile dealt on its own (a group of cards in one language, say), its cards' keys and holds are all that is kept, and commands stream past. Desks run side by side.
    """
    none = lambda t: F.lit(None).cast(t)
    rows = cards.select("desk", F.lit(0).alias("kind"), none("timestamp").alias("ts"), F.col("ord").cast("long").alias("seq"), none("long").alias("who"), none("string").alias("verb"), "card", none("long").alias("pid"), none("string").alias("verdict"), F.col("pids").cast("array<bigint>").alias("pids")).unionByName(
        commands.select("desk", F.lit(1).alias("kind"), F.col("ts").cast("timestamp").alias("ts"), "seq", F.col("who").cast("long").alias("who"), "verb", "card", F.col("pid").cast("long").alias("pid"), "verdict", none("array<bigint>").alias("pids"))
    )
    rows = rows.repartition("desk").sortWithinPartitions("desk", "kind", "ts", "seq")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, desk = None, Desk()
        for b in batches:
            out = []
            for where, kind, ts, seq, who, verb, card, pid, verdict, pids in b.itertuples(index=False, name=None):
                if where != name:
                    name, desk = where, Desk()
                if kind == 0:
                    desk.order.append(card)
                    desk.pids[card] = list(pids) if pids is not None else []
                    continue
                who = int(who)
                if verb == "take":
                    card = desk.take(who, ts)
                    done = card is not None
                elif verb == "claim":
                    done = desk.claim(card, who, ts)
                elif verb == "renew":
                    done = desk.renew(card, who, ts)
                elif verb == "release":
                    done = desk.release(card, who)
                elif verb == "decide":
                    # without a card it is the one the reviewer holds, without a proposal that card's first
                    card = card or next((c for c, (w, _) in desk.holds.items() if w == who), None)
                    p = int(pid) if pid == pid and pid is not None else next(iter(desk.pids.get(card, ())), -1)
                    done = card is not None and desk.decide(card, who, p, verdict)
                    if done:
                        desk.release(card, who)
                else:
                    done = pid == pid and pid is not None and desk.mark_done(who, int(pid))
                out.append((where, seq, who, verb, card, bool(done)))
            yield pd.DataFrame(out, columns=["desk", "seq", "who", "verb", "card", "done"])

    return rows.mapInPandas(run, OUT)


class Pile:
    """The state of one labelling task. What can be dealt is found without passing over the items that cannot: labels stay, so a labeller's place among the shared items only moves on, and of the others those neither labelled nor held are kept as a heap."""

    def __init__(self, shared: int) -> None:
        self.most, self.order, self.shared, self.rest, self.place = shared, {}, [], [], {}
        self.labels: dict[str, set[str]] = {}
        self.holds: dict[str, tuple[str, object]] = {}
        self.held: dict[str, str] = {}
        self.last: dict[str, str | None] = {}
        self.at: dict[str, int] = {}
        #: Places in ``rest`` that may be free; holds by the time they end.
        self.free: list[int] = []
        self.ends: list[tuple[object, int]] = []

    def add(self, item: str, ord_: int) -> None:
        if item in self.order:
            return
        self.order[item] = ord_
        if ord_ <= self.most:
            self.shared.append(item)
        else:
            self.place[item] = len(self.rest)
            heapq.heappush(self.free, len(self.rest))
            self.rest.append(item)

    def live(self, item: str | None, now) -> bool:
        return item in self.holds and now < self.holds[item][1]

    def give_back(self, who: str) -> bool:
        """A labeller has one hold at most, run out or not; it is theirs until someone else takes the item."""
        item = self.held.pop(who, None)
        if item is None or self.holds.get(item, (None, None))[0] != who:
            return False
        del self.holds[item]
        heapq.heappush(self.free, self.place[item])
        return True

    def take(self, who: str, now) -> str | None:
        n = self.at.get(who, 0)
        while n < len(self.shared) and who in self.labels.get(self.shared[n], ()):
            n += 1
        self.at[who], item = n, self.shared[n] if n < len(self.shared) else None
        if item is None:
            self.give_back(who)
            while self.ends and self.ends[0][0] <= now:
                heapq.heappush(self.free, heapq.heappop(self.ends)[1])
            while self.free and item is None:
                item = self.rest[heapq.heappop(self.free)]
                item = None if item in self.labels or self.live(item, now) else item
            if item is not None:
                until = now + pd.Timedelta(minutes=HOLD)
                self.holds[item], self.held[who] = (who, until), item
                heapq.heappush(self.ends, (until, self.place[item]))
        self.last[who] = item
        return item

    def save(self, item: str | None, who: str, now) -> bool:
        others = bool(self.labels.get(item, set()) - {who}) or (self.live(item, now) and self.holds[item][0] != who)
        done = item in self.order and (self.order[item] <= self.most or not others)
        if done:
            self.labels.setdefault(item, set()).add(who)
            if item in self.holds and self.holds[item][0] == who:
                del self.holds[item]
                del self.held[who]
        return done


def replay_labelling(items: DataFrame, commands: DataFrame, shared: int) -> DataFrame:
    """task, seq, labeller, verb, item, done of take, save and release commands on evaluation items, in the order of (ts, seq) of each task.

    ``items``: task, ord (from 1), item; ``commands``: task, seq, ts, labeller, verb, item. Items up to ``shared`` go to everybody who has not labelled them and are never held; every other goes to one labeller, who
    holds it, and only that one may save it. A save without an item is of the last one taken.
    """
    none = lambda t: F.lit(None).cast(t)
    rows = items.select("task", F.lit(0).alias("kind"), none("timestamp").alias("ts"), F.col("ord").cast("long").alias("seq"), none("string").alias("labeller"), none("string").alias("verb"), "item").unionByName(
        commands.select("task", F.lit(1).alias("kind"), F.col("ts").cast("timestamp").alias("ts"), "seq", F.col("labeller").cast("string").alias("labeller"), "verb", "item")
    )
    rows = rows.repartition("task").sortWithinPartitions("task", "kind", "ts", "seq")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, pile = None, Pile(shared)
        for b in batches:
            out = []
            for task, kind, ts, seq, who, verb, item in b.itertuples(index=False, name=None):
                if task != name:
                    name, pile = task, Pile(shared)
                if kind == 0:
                    pile.add(item, int(seq))
                    continue
                if verb == "take":
                    item = pile.take(who, ts)
                    done = item is not None
                elif verb == "save":
                    item = item or pile.last.get(who)
                    done = pile.save(item, who, ts)
                else:
                    done = pile.give_back(who)
                out.append((task, seq, who, verb, item, bool(done)))
            yield pd.DataFrame(out, columns=["task", "seq", "labeller", "verb", "item", "done"])

    return rows.mapInPandas(run, "task string, seq long, labeller string, verb string, item string, done boolean")
