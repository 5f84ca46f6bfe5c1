"""Benchmark decontamination: a BM25 index of test items, queried by every passage with block-max WAND.

Impacts are BM25 contributions divided by what an item scores against itself, so a score runs from 0 to 1 and
one threshold fits short and long items. Passages are overlapping windows of twice the longest item. Before the
per-passage search, array operations bound all passages of a batch: first by the terms' best impacts, then by
their best impacts within ranges of items. What the search finds is checked for its question and its answer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, materialize
from tickloom.llm.shingles import SIZE, WORDS
from tickloom.session import ship

K1, B = 1.2, 0.75
#: Least normalised score of a retrieved item, and least part of its question's and answer's shingles found.
SCORE, OVERLAP = 0.6, 0.8
#: Postings in a block, and cells of the table of range maxima.
POSTINGS, CELLS = 8, 4_000_000
#: Text bytes of the test items in one broadcast index; larger benchmarks are searched in several shards.
SHARD_BYTES = 16_000_000
SENTENCE = re.compile(r"(?<=[.!?])\s+")
LEAKS = "array<struct<item:bigint,score:double,question:double,answer:double>>"


def terms(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + SIZE]) for i in range(max(1, len(words) - SIZE + 1))} if words else set()


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words of all sentences but the last, and of the last; one sentence is both."""
    parts = [w for s in SENTENCE.split(text.strip()) if (w := terms(s))]
    return list(chain.from_iterable(parts[:-1])) or parts[-1], parts[-1]


@dataclass
class Whole:
    """What scores and passages take from all items of a benchmark that have words.

    frequencies has the items of each term, for the terms of one shard at least.
    """

    items: int
    words: int
    longest: int
    frequencies: dict[str, int]


class Index:
    """Inverted lists with block maxima. Items without words are left out. texts may be a shard of a whole."""

    def __init__(self, texts: list[str], whole: Whole | None = None):
        words = [terms(t) for t in texts]
        self.items = [i for i, w in enumerate(words) if w]
        self.parts = {i: tuple(map(shingles, question_and_answer(texts[i]))) for i in self.items}
        sizes = np.array([len(words[i]) for i in self.items])
        lists: dict[str, list[tuple[int, int]]] = {}
        for n, i in enumerate(self.items):
            found, counts = np.unique(words[i], return_counts=True)
            for w, c in zip(found.tolist(), counts.tolist()):
                lists.setdefault(w, []).append((n, c))
        whole = whole or Whole(len(sizes), int(sizes.sum()), int(sizes.max(initial=0)), {w: len(found) for w, found in lists.items()})
        self.step = max(32, whole.longest)
        mean = whole.words / max(1, whole.items)
        self.vocabulary = {w: k for k, w in enumerate(lists)}
        self.postings: list[tuple[list[int], list[float]]] = []
        total = np.zeros(len(self.items))
        raw = []
        for w, found in lists.items():
            n, c = np.array(found).T
            df = whole.frequencies[w]
            idf = np.log(1 + (whole.items - df + 0.5) / (df + 0.5))
            raw.append((n, idf * c * (K1 + 1) / (c + K1 * (1 - B + B * sizes[n] / mean))))
            total[n] += raw[-1][1]
        self.ranges = max(1, min(len(self.items), 64, CELLS // max(1, len(raw))))
        self.range_of = np.arange(len(self.items)) * self.ranges // max(1, len(self.items))
        self.best = np.zeros((len(raw), self.ranges), np.float32)
        self.blocks: list[tuple[list[int], list[float]]] = []
        for k, (n, x) in enumerate(raw):
            x = x / total[n]
            np.maximum.at(self.best[k], self.range_of[n], np.nextafter(x.astype(np.float32), np.float32(np.inf)))
            self.postings.append((n.tolist(), x.tolist()))
            starts = range(0, len(n), POSTINGS)
            self.blocks.append(([int(n[min(s + POSTINGS, len(n)) - 1]) for s in starts], [float(x[s : s + POSTINGS].max()) for s in starts]))
        self.bound = self.best.max(1) if len(raw) else np.zeros(0, np.float32)

    def search(self, query: list[int], least: float) -> list[tuple[int, float]]:
        """All items whose score for these distinct terms is at least `least`, by block-max WAND."""
        found: list[tuple[int, float]] = []
        cursors = [[self.postings[t][0][0], 0, t] for t in query]
        bound = self.bound
        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for i, (_, _, t) in enumerate(cursors):
                total += bound[t]
                if total >= least:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block, until = 0.0, len(self.items)
            for _, at, t in cursors[: pivot + 1]:
                last, most = self.blocks[t]
                b = at // POSTINGS
                while b < len(last) and last[b] < item:
                    b += 1
                if b < len(last):
                    block += most[b]
                    until = min(until, last[b] + 1)
            if pivot + 1 < len(cursors):
                until = min(until, cursors[pivot + 1][0])
            if block < least:
                goal, moved = max(until, item + 1), cursors[: pivot + 1]
            elif cursors[0][0] == item:
                score = sum(self.postings[t][1][at] for _, at, t in cursors[: pivot + 1])
                if score >= least:
                    found.append((item, score))
                goal, moved = item + 1, cursors[: pivot + 1]
            else:
                goal, moved = item, [c for c in cursors[:pivot] if c[0] < item]
            for c in moved:
                ids = self.postings[c[2]][0]
                while c[1] < len(ids) and ids[c[1]] < goal:
                    c[1] += 1
                c[0] = ids[c[1]] if c[1] < len(ids) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def passages(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[str]]]:
        """(text of each passage; distinct (passage, term) pairs in order; the texts' words)."""
        words = [terms(t) for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        blocks = -(-sizes // self.step)
        windows = np.where(sizes > 0, np.maximum(blocks - 1, 1), 0)
        base = np.cumsum(windows) - windows
        known = np.fromiter((self.vocabulary.get(w, -1) for w in chain.from_iterable(words)), np.int64, int(sizes.sum()))
        text = np.repeat(np.arange(len(words)), sizes)
        at = (np.arange(len(known)) - np.repeat(np.cumsum(sizes) - sizes, sizes)) // self.step
        use = known >= 0
        known, text, at = known[use], text[use], at[use]
        one, two = at < windows[text], at > 0
        v = len(self.vocabulary) + 1
        key = np.concatenate([(base[text[one]] + at[one]) * v + known[one], (base[text[two]] + at[two] - 1) * v + known[two]])
        key.sort()
        key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
        return np.repeat(np.arange(len(words)), windows), key // v, key % v, words

    def leaks(self, texts: list[str]) -> list[list[tuple[int, float, float, float]]]:
        """For each text the items it leaks: (item, best score, question overlap, answer overlap), by item."""
        out: list[list[tuple[int, float, float, float]]] = [[] for _ in texts]
        if not self.items:
            return out
        of, passage, term, words = self.passages(texts)
        slack = 1 - 1e-5
        if len(passage):
            hope = np.bincount(passage, self.bound[term], len(of)) >= SCORE * slack
            use = hope[passage]
            passage, term = passage[use], term[use]
        best: dict[tuple[int, int], float] = {}
        for i in range(0, len(passage), 200_000):
            lo = i if i == 0 or passage[i] != passage[i - 1] else int(np.searchsorted(passage, passage[i], "right"))
            hi = int(np.searchsorted(passage, passage[min(i + 200_000, len(passage)) - 1], "right"))
            if lo >= hi:
                continue
            p, t = passage[lo:hi], term[lo:hi]
            first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
            most = np.add.reduceat(self.best[t], first, axis=0).max(1)
            ends = np.append(first[1:], len(p))
            for j in np.flatnonzero(most >= SCORE * slack).tolist():
                for item, score in self.search(t[first[j] : ends[j]].tolist(), SCORE):
                    k = (int(of[p[first[j]]]), item)
                    best[k] = max(score, best.get(k, 0.0))
        held: tuple[int, set] = (-1, set())
        for (text, item), score in sorted(best.items()):
            if held[0] != text:
                held = text, shingles_of_all(words[text])
            parts = [self._found(part, held[1]) for part in self.parts[self.items[item]]]
            if min(parts) >= OVERLAP:
                out[text].append((self.items[item], score, *parts))
        return out

    @staticmethod
    def _found(part: set[tuple[str, ...]], known: dict[int, set[tuple[str, ...]]]) -> float:
        return sum(s in known[len(s)] for s in part) / len(part)


def shingles_of_all(words: list[str]) -> dict[int, set[tuple[str, ...]]]:
    """Word runs of one to SIZE words, by length: short questions and answers are looked up whole."""
    return {n: set(zip(*(words[i:] for i in range(n)))) for n in range(1, SIZE + 1)}


def _column(text: Column, ids: list[int], items: list[str], whole: Whole | None) -> Column:
    """Array column of the leaks of a text against one shard of items, which travels with the task."""

    @F.pandas_udf(LEAKS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(items, whole)
        for texts in batches:
            out: list = []
            for i in range(0, len(texts), 100):
                part = ["" if t is None else str(t) for t in texts.iloc[i : i + 100]]
                out += [[{"item": int(ids[a]), "score": b, "question": c, "answer": d} for a, b, c, d in found] for found in index.leaks(part)]
            yield pd.Series(out, dtype=object)

    return find(text)


def shards(items: DataFrame, key: str, text: str) -> list[tuple[list, list[str], Whole | None]]:
    """Ids and texts of the items, in shards of bounded size, each with the figures of all shards if it is not alone."""
    ship(items.sparkSession)
    rows = items.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null and k is not null")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-size // SHARD_BYTES))
    parts = [rows.where(F.pmod(F.xxhash64("k"), F.lit(n)) == i) for i in range(n)]
    wholes = _wholes(rows, parts) if n > 1 else [None]
    out = []
    for part, whole in zip(parts, wholes):
        found = part.toPandas().sort_values(["k", "t"])
        out.append((found["k"].tolist(), found["t"].tolist(), whole))
    return out


def _wholes(rows: DataFrame, parts: list[DataFrame]) -> Iterator[Whole]:
    """For each part of the items, the figures of them all; terms are found by the same code as in an index."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [terms(t) for t in batch["t"]]
            yield pd.DataFrame({"n": pd.Series(map(len, words), dtype="int64"), "w": pd.Series([sorted(set(w)) for w in words], dtype=object)})

    split = lambda items: items.select("t").mapInPandas(found, "n long, w array<string>").where("n > 0")
    counts = split(rows).agg(F.count(F.lit(1)), F.sum("n"), F.max("n")).first()
    often = materialize(split(rows).select(F.explode("w").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df")))
    for part in parts:
        own = split(part).select(F.explode("w").alias("w")).distinct()
        table = often.join(own, "w", "left_semi").toPandas()
        yield Whole(*(x or 0 for x in counts), dict(zip(table["w"], table["df"].tolist())))


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (doc_id, item_id, score, question_overlap, answer_overlap): each test item that a row of docs leaks.

    Retrieved: every item with a normalised BM25 score of at least SCORE for a passage. Kept: those of whose
    question and whose answer at least OVERLAP of the five-word shingles stand in the text. Null and empty texts
    leak nothing; repeated rows each give their rows; an empty benchmark or table gives none.
    """
    out = None
    for ids, texts, whole in shards(items, item_key, item_text):
        rows = docs.select(F.col(key).alias("doc_id"), F.explode(_column(F.col(text), ids, texts, whole)).alias("x"))
        rows = rows.select("doc_id", F.col("x.item").alias("item_id"), "x.score", F.col("x.question").alias("question_overlap"), F.col("x.answer").alias("answer_overlap"))
        out = rows if out is None else out.union(rows)
    return out


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs, with their columns, without rows that leak a test item."""
    for ids, texts, whole in shards(items, item_key, item_text):
        own = free_name(docs, "leaks")
        docs = docs.withColumn(own, F.size(_column(F.col(text), ids, texts, whole))).where(F.col(own) == 0).drop(own)
    return docs
