"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch lie one after another in one flat numpy array of symbol ids. In every round each
sequence finds its lowest-ranked adjacent pair and merges all its occurrences at once, for all sequences
of the batch in the same array operations. A sequence without a known pair is done: its count is the
number of symbols left.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import ship
from pyspark.sql import types as T

#: The public pattern that splits text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

NO_RANK = np.iinfo(np.int64).max
#: Counts of pre-tokens kept by a worker, and the longest pre-token kept.
CACHE_ENTRIES, CACHE_LENGTH = 300_000, 64
#: Bytes merged in one array operation, unless a single pre-token is longer.
FLAT_BYTES = 2_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class RankMerger:
    """Counts the tokens of a byte-level BPE vocabulary file (the .json kind)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, pairs = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in pairs]
        self.base = max(vocab.values()) + 1
        self.bytes = np.array([vocab[s] for s in byte_symbols()], dtype=np.int64)
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)[order]
        specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.split = regex.compile(PATTERN)
        self.cache: dict[str, int] = {}

    def merge(self, words: list[bytes]) -> np.ndarray:
        """Number of tokens of each pre-token."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.zeros(len(words), np.int64)
        flat = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        while len(flat):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            length = np.diff(np.r_[first, len(flat)])
            key = flat[:-1] * self.base + flat[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (owner[1:] == owner[:-1])
            rank = np.append(np.where(known, self.ranks[at], NO_RANK), NO_RANK)
            lowest = np.minimum.reduceat(rank, first)
            done = lowest == NO_RANK
            counts[owner[first[done]]] = length[done]
            hit = np.flatnonzero((rank == np.repeat(lowest, length)) & (rank != NO_RANK))
            if len(hit) > 1 and (near := np.diff(hit) == 1).any():
                # a pair of equal symbols can overlap itself: from the left, every second one merges
                run = np.r_[0, np.flatnonzero(~near) + 1]
                offset = np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))
                hit = hit[offset % 2 == 0]
            flat[hit] = self.merged[at[hit]] if len(hit) else 0
            keep = np.repeat(~done, length)
            keep[hit + 1] = False
            flat, owner = flat[keep], owner[keep]
        return counts

    def learn(self, words: list[str]) -> dict[str, int]:
        found, part, size = {}, [], 0
        for i, w in enumerate(words):
            part.append(w)
            size += len(w)
            if size >= FLAT_BYTES or i == len(words) - 1:
                found.update(zip(part, self.merge([p.encode("utf-8") for p in part]).tolist()))
                part, size = [], 0
        return found

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; a special token inside a text counts as one."""
        pieces, extra = [], []
        for t in texts:
            parts = self.special.split(t) if self.special and t else [t or ""]
            pieces.append([w for p in parts for w in self.split.findall(p)])
            extra.append(len(parts) - 1)
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        fresh = set().union(*pieces) - self.cache.keys() if pieces else set()
        found = self.learn(sorted(fresh))
        for w, n in found.items():
            if len(w) <= CACHE_LENGTH:
                self.cache[w] = n
        long = {w: n for w, n in found.items() if len(w) > CACHE_LENGTH}
        known = _Chain(self.cache, long) if long else self.cache
        return [sum(map(known.__getitem__, p)) + e for p, e in zip(pieces, extra)]


class _Chain(dict):
    """Looks into the cache first and then among the long pre-tokens of this batch."""

    def __init__(self, cache: dict[str, int], long: dict[str, int]):
        super().__init__(long)
        self.cache = cache

    def __getitem__(self, key: str) -> int:
        n = self.cache.get(key)
        return dict.__getitem__(self, key) if n is None else n


def token_count(text: Column | str, vocab_path: str) -> Column:
    """Column of type long: tokens of text under the vocabulary at vocab_path (present on every worker)."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        merger = RankMerger(vocab_path)
        for texts in batches:
            out = []
            for i in range(0, len(texts), 100):
                out += merger.count([None if t is None else str(t) for t in texts.iloc[i : i + 100]])
            yield pd.Series(out, dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, vocab_path: str, text: str = "text", key: str = "doc_id", limit: int = 1024) -> DataFrame:
    """Rows (key, n_bytes, n_tokens, over_limit), one for every row of docs.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows, null keys and extra columns are fine;
    only key and text are read. An empty table gives an empty result. Texts are never cut: a pre-token of
    any length is merged whole. Narrow: no shuffle, memory bounded by an Arrow batch and the cache.
    """
    ship(docs.sparkSession)
    return (
        docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
        .select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), token_count("text", vocab_path).alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
