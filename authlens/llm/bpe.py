"""Byte-level BPE of whole texts, in time linear in the text.

Merging pair after pair is quadratic in a long word. Here every token that starts anywhere in a word is found by one
pass of an Aho-Corasick automaton (bytes are mapped to Latin-1, as it takes text), and the word is walked from its
start with the longest token first. A token may follow another only if the two, written together, encode to just
those two; that is memoised. An encoding whose neighbours are all compatible is the one that merging would give. A
place from which no token leads on is marked and never tried again, so each place is left at most once a token.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spread

#: Where the vocabulary files of public tokenizers lie.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: how this family of vocabularies splits a text before it merges.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE = 200_000


class Encoder:
    """Ids of a text under a byte-level vocabulary in which a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        self.ranks, self.words = ranks, regex.compile(pattern)
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.found = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.found.add_word(token.decode("latin-1"), (i, len(token)))
        self.found.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.cache: dict[str, tuple[int, ...]] = {}

    def merged(self, data: bytes) -> list[int]:
        """The textbook way: the pair of lowest rank is merged until none is left. Only for two tokens at a time."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def fit(self, a: int, b: int) -> bool:
        known = self.fits.get((a, b))
        if known is None:
            known = self.fits[a, b] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def word(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (i, size) in self.found.iter(data.decode("latin-1")):
            starts[end - size + 1].append((i, size))  # by growing size
        shut = bytearray(n + 1)
        at, ids, turns = 0, [], [len(starts[0])]
        while at < n:
            here, turn = starts[at], turns[-1]
            last = ids[-1] if ids else -1
            while turn:
                turn -= 1
                i, size = here[turn]
                if not shut[at + size] and (last < 0 or self.fit(last, i)):
                    turns[-1] = turn
                    ids.append(i)
                    at += size
                    turns.append(len(starts[at]) if at < n else 0)
                    break
            else:
                shut[at] = 1
                turns.pop()
                at -= len(self.bytes_of[ids.pop()])
        return ids

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        if not text:
            return ids
        cache = self.cache
        for piece in self.words.findall(text):
            known = cache.get(piece)
            if known is None:
                known = tuple(self.word(piece.encode()))
                if len(piece) <= 64:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[piece] = known
            ids += known
        return ids


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


_made: dict[str, Encoder] = {}


def _encoder(vocabulary) -> Encoder:
    """One encoder a Python worker and vocabulary, known by the vocabulary's name and digest."""
    key, ranks = vocabulary.value
    if key not in _made:
        _made.clear()
        _made[key] = Encoder(ranks)
    return _made[key]


def _vocabulary(spark: SparkSession, name: str, folder: str):
    """The vocabulary goes out once, as a broadcast: about a megabyte whatever the corpus."""
    path = f"{folder}/{name}.tiktoken"
    with open(path, "rb") as f:
        digest = hashlib.sha256(f.read()).hexdigest()
    return spark.sparkContext.broadcast((f"{name}:{digest}", read_ranks(path)))


def with_ids(docs: DataFrame, text: str = "text", out: str = "ids", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Adds the list of ids of each text, special tokens being ordinary text; null and empty texts give an empty list."""
    ranks = _vocabulary(docs.sparkSession, name, folder)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = _encoder(ranks)
        for batch in batches:
            yield pd.Series([np.array(e.encode(t), dtype=np.int32) for t in batch], dtype=object)

    return docs.withColumn(out, ids(text))


def with_counts(docs: DataFrame, text: str = "text", out: str = "tokens", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Adds the number of ids of each text, 0 for null and empty ones, without shipping the ids back."""
    ranks = _vocabulary(docs.sparkSession, name, folder)

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = _encoder(ranks)
        for batch in batches:
            yield pd.Series([len(e.encode(t)) for t in batch], dtype="int32")

    return docs.withColumn(out, count(text))


def corpus_ids(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """doc_id, ids of every document; one row in, one row out, no shuffle on inputs of enough splits."""
    return with_ids(spread(docs.select("doc_id", "text")), folder=folder).select("doc_id", "ids")
