"""Names as people write them: their parts, and how alike two of them are."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from .confusables import PROTOTYPE, clean

# Forms of address, particles between names, words that carry no identity.
TITLES = set("mr mrs ms mdm madam miss dr prof professor assoc associate asst sir dame lady lord haji hajjah hj hjh datuk dato datin puan encik tuan cik rev justice hon".split())
LINKS = set("bin binte binti bte s/o d/o so do a/l a/p al ap".split())
EMPTY = set("the of and a an di de da la ltd pte inc son daughter".split())
DENSE = re.compile("[⺀-鿿぀-ヿ가-힯豈-﫿]")
_BRACKET = re.compile(r"^(.*?)\s*[(（\[【]([^)）\]】]*)[)）\]】]\s*(.*)$")
_LINK = re.compile(r"\b([sd])/o\b|\ba/([lp])\b")
#: Where a space is lost: a capital inside a word that isn't all capitals, Mac and Mc aside, or after a title or an acronym.
_GLUED = re.compile(r"(?<=[a-z]{2})(?<!\bMac)(?=[A-Z])|(?<=\b[DM]r)(?=[A-Z])|(?<=\bMs)(?=[A-Z])|(?<=[A-Z]{3})(?=[A-Z][a-z]{2})")
_NICK = re.compile(r"(?<=\s)['‘“\"][^'’”\"\s]+['’”\"](?=\s)")


def plain(text: str) -> str:
    """Look-alikes undone, lost spaces put back, lower case, accents dropped (of Latin, Greek and Cyrillic letters only)."""
    t = "".join(c for c in unicodedata.normalize("NFD", clean(text) or "") if not "̀" <= c <= "ͯ")
    return unicodedata.normalize("NFC", "".join(PROTOTYPE.get(c, c) for c in _GLUED.sub(" ", t).lower()))


@lru_cache(20_000)
def aliases(text: str) -> tuple[str, ...]:
    """The name, or two names where a bracket repeats it in another script."""
    m = _BRACKET.match(text)
    if m:
        outer, inner = f"{m[1]} {m[3]}".strip(), m[2].strip()
        dense = lambda s: bool(DENSE.search(s)) or any(ord(c) > 0x590 for c in s)
        if outer and inner and dense(outer) != dense(inner):
            return outer, inner
    return (text,)


def written(names) -> list[str]:
    """All names of a thing, brackets taken apart, in a fixed order."""
    return sorted({a for n in names if n for a in aliases(n)})


@lru_cache(50_000)
def parts(text: str) -> tuple[str, ...]:
    """The words that identify, in order: no titles, particles or empty words; initials stay as single letters."""
    t = _LINK.sub(" ", _NICK.sub("", plain(text))).replace("'", "").replace("’", "").replace("‘", "")
    words = "".join(c if c.isalnum() or unicodedata.category(c)[0] == "M" else " " for c in t).split()
    kept = [w for w in words if w not in TITLES and w not in LINKS and w not in EMPTY]
    return tuple(kept or words)


@lru_cache(100_000)
def near(a: str, b: str) -> float:
    """How alike two words are: 1 equal, 0 not alike. One slip for each five letters, neighbours swapped counting as one; an initial, a shortening or a pet form stands for its word."""
    if a == b:
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if DENSE.search(b) or not a:
        return 0.0
    if m == 1:
        return 0.75 if b[0] == a else 0.0
    if n - m <= 2 and n >= 4:
        most = 1 if n < 8 else 2
        found = slips(a, b, most)
        if found <= most:
            return 0.9 if found <= 1 else 0.8
    if a[0] == b[0] and m < n and m <= 0.75 * n:
        it = iter(b)
        if b.startswith(a) or all(c in it for c in a) and (not set(a[1:]) & set("aeiou") or (m >= 3 and a[-1] == b[-1] and n >= 7)):
            return 0.85 if m >= 3 else 0.7
    if 3 < m < 7 and m < n:
        stem = a[:-2] if a.endswith("ie") else a[:-1] if a[-1] in "yo" else ""
        if len(stem) > 2 and b.startswith(stem):
            return 0.8
    return 0.0


def slips(a: str, b: str, most: int) -> int:
    """Edits between two words, neighbours swapped counting as one; more than ``most`` is ``most + 1``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    # what both begin and end with needs no edit
    i, m, n = 0, len(a), len(b)
    while i < m and i < n and a[i] == b[i]:
        i += 1
    while m > i and n > i and a[m - 1] == b[n - 1]:
        m, n = m - 1, n - 1
    a, b = a[i:m], b[i:n]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    if len(a) == 2 == len(b) and a[0] == b[1] and a[1] == b[0]:
        return 1
    if len(a) == 1 == len(b):
        return 1
    # what is left begins and ends differently, so one edit cannot do; each letter that the other lacks needs an edit
    if most < 2 or len(set(a) - set(b)) > most or len(set(b) - set(a)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def similarity(a: tuple[str, ...], b: tuple[str, ...], weight, extra_a: float = 0.8, extra_b: float = 0.45) -> float:
    """Weighted share of words that agree, in any order. ``weight``: of a word; ``extra_a``, ``extra_b``: what a word only one of the names has counts."""
    if a == b or "".join(a) == "".join(b):
        return 1.0
    if len(a) == len(b) and sorted(a) == sorted(b):
        return 0.99
    free = list(b)
    got = total = 0.0
    rest: list[str] = []
    for x in a:
        if x in free:
            free.remove(x)
            w = weight(x)
            got += w
            total += w
        else:
            rest.append(x)
    for x in sorted(rest, key=len, reverse=True):
        best, hit = 0.0, ""
        n, first, last = len(x), x[0], x[-1]
        for y in free:
            # words that begin otherwise are near by slips alone, and one slip leaves the first or the last letter
            if y[0] != first and (abs(len(y) - n) > 2 or (y[-1] != last and n < 8 and len(y) < 8)):
                continue
            s = near(x, y)
            if s > best:
                best, hit = s, y
        w = weight(x)
        if best:
            free.remove(hit)
            w = max(w, weight(hit)) if len(x) > 1 else 0.5 * weight(hit)
            got += best * w
            total += w
        else:
            # two words written as one
            joined = next(((p, q) for p in free for q in free if p != q and abs(len(p) + len(q) - len(x)) < 2 and near(x, p + q) >= 0.9), None) if n >= 6 and len(free) > 1 else None
            if joined:
                for p in joined:
                    free.remove(p)
                    w = weight(p)
                    got += 0.95 * w
                    total += w
            else:
                total += extra_a * (w if len(x) > 1 else 0.3 * w)
    used = set()
    short = next((x for x in rest if 2 < len(x) < 8 and x == "".join(w[0] for w in b)), None)
    if short:
        # an acronym beside the name says nothing new; instead of the name's words it stands for them
        total -= extra_a * weight(short)
        got += 0.85 * sum(map(weight, free))
        total += sum(map(weight, free))
        free = []
    for y in free:
        mates = [x for x in rest if len(x) > len(y) and x.endswith(y) and x not in used]
        total += extra_b * (0.2 if mates else weight(y) if len(y) > 1 else 0.3 * weight(y))
        used.update(mates)
    return got / total if total else 0.0


def alike(a: str, b: str) -> float:
    """:func:`near`, but short words that begin otherwise are two words, as syllables are, unless their letters are the same."""
    if a[0] != b[0] and max(len(a), len(b)) < 6 and sorted(a) != sorted(b):
        return 0.0
    return near(a, b)


def compatible(kind: str, a: tuple[str, ...], b: tuple[str, ...], common) -> bool:
    """Whether two names can be one: every word of one of them has a like word in the other, and enough words agree.

    A person's longer name may have one more word, an organisation's one more of the words many names have
    (``common``), beside initials; words that only one has on both sides speak against it, as do two different branches.
    """
    if a == b:
        return True
    left, right, agree, firm = list(a), list(b), 0, 0
    for w in a:
        if w in right:
            left.remove(w)
            right.remove(w)
            agree += 1
            firm += len(w) > 1
    for w in sorted(left, key=len, reverse=True):
        best = max(right, key=lambda y: alike(w, y), default="")
        if best and alike(w, best):
            left.remove(w)
            right.remove(best)
            agree += 1
            firm += len(w) > 1 and len(best) > 1
    for one, other in ((left, right), (right, left)):
        for w in [w for w in one if len(w) >= 6]:
            pair = next(((p, q) for p in other for q in other if p is not q and abs(len(p) + len(q) - len(w)) < 2 and near(w, p + q) >= 0.9), None)
            if pair:
                one.remove(w)
                for p in pair:
                    other.remove(p)
                agree += 2
                firm += 2
        for w in [w for w in one if 2 < len(w) < 8]:
            whole = b if one is left else a
            if sorted(w) == sorted(x[0] for x in whole) and firm:
                one.remove(w)
                other.clear()
                agree += 2
    if left and right or not firm:
        return False
    rest = [w for w in left + right if len(w) > 1]
    if kind == "PERSON":
        return len(rest) <= 1 and agree >= 2
    return len(rest) <= 1 and agree >= 2 and all(w in common for w in rest)
