"""Language identification with segmentation-marginalised unigrams.

Each language has one probability per piece of a fixed public vocabulary. The probability of a word is the
sum over all ways to cut it into pieces of the product of their probabilities (forward algorithm), and the
words of a text are independent. Pieces never cross words, so word scores are computed once per batch for
the distinct words only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import ship

UNDETERMINED = "und"
WORD_START = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
#: Letters of the words that are scored many at a time, in plain probabilities; longer ones are scored one by one, in
#: logarithms, so that nothing underflows.
SHORT = 36
#: Probability of a character that no piece covers.
FLOOR = 1e-7
#: Texts whose letters are less likely than this on average (natural logarithm) in every language are rejected:
#: about half of their letters stand in no piece that a language uses.
LEAST_PER_LETTER = -7.0
#: Added to each piece's count in each language.
SMOOTHING = 0.1
#: Rows that each language has in the training sample, if it has so many; values of the hash that draws them.
LEAST, HASHES = 30, 1 << 53
#: Distinct words kept by a worker, times languages.
CACHE_CELLS = 1_600_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = "lang_pred string, score double, per_letter double"


def words_of(text: str) -> list[str]:
    """Runs of letters (Unicode category L) in lower case."""
    found = LETTERS.findall(text.lower())
    if "".join(found).isalpha():
        return found
    # numerals such as fractions count as word characters, but are no letters
    return [w for f in found for w in "".join(c if c.isalpha() else " " for c in f).split()]


def load_pieces(path: str) -> list[str]:
    """Pieces of a sentencepiece model or of a byte-level vocabulary's plain-text entries."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return ["" if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) else model.id_to_piece(i) for i in range(model.get_piece_size())]


def hashes(points: np.ndarray) -> np.ndarray:
    """One 64-bit hash per row of code points."""
    h = np.full(len(points), 7, np.uint64)
    for j in range(points.shape[1]):
        h = (h ^ points[:, j].astype(np.uint64)) * MULTIPLIER
        h ^= h >> np.uint64(29)
    return h


class Lattice:
    """Finds, for many words at once, which substrings are pieces of the vocabulary."""

    def __init__(self, pieces: list[str]):
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if p:
                by_length.setdefault(len(p), []).append(i)
        self.size = len(pieces)
        self.tables = {}
        for n, ids in by_length.items():
            h = hashes(np.array([[ord(c) for c in pieces[i]] for i in ids], np.uint32))
            order = np.argsort(h)
            self.tables[n] = h[order], np.array(ids)[order]

    def spans(self, points: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """(start, piece id) of the pieces in one string, by their end."""
        found: dict[int, list[tuple[int, int]]] = {}
        for n, (known, ids) in self.tables.items():
            if n <= len(points):
                h = hashes(np.lib.stride_tricks.sliding_window_view(points, n))
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                for start in np.flatnonzero(known[at] == h).tolist():
                    found.setdefault(start + n, []).append((start, int(ids[at[start]])))
        return found

    def edges(self, points: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(end, piece length, rows, piece ids), by increasing end; a pair of row and span comes once."""
        for end in range(1, points.shape[1] + 1):
            for n, (known, ids) in sorted(self.tables.items()):
                if n <= end and len(rows := np.flatnonzero(lengths >= end)):
                    h = hashes(points[rows, end - n : end])
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    hit = known[at] == h
                    if hit.any():
                        yield end, n, rows[hit], ids[at[hit]]


@dataclass
class Model:
    """Languages in code-point order, the vocabulary's path and the piece probabilities (pieces x languages)."""

    languages: list[str]
    vocab_path: str
    probabilities: np.ndarray


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.lattice = Lattice(load_pieces(model.vocab_path))
        self.index: dict[str, int] = {}
        self.table = np.zeros((0, len(model.languages)))

    def forward(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language, over all segmentations."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        points = np.zeros((len(words), int(lengths.max())), np.uint32)
        flat = np.frombuffer("".join(WORD_START + w for w in words).encode("utf-32-le"), np.uint32)
        points[np.arange(points.shape[1]) < lengths[:, None]] = flat
        alpha = np.zeros((points.shape[1] + 1, len(words), len(self.model.languages)))
        alpha[0] = 1
        last = 0
        for end, n, rows, ids in self.lattice.edges(points, lengths):
            for e in range(last + 1, end):  # a character without a piece costs the floor
                self._floor(alpha, e)
            last = end - 1
            alpha[end, rows] += alpha[end - n, rows] * self.model.probabilities[ids]
        for e in range(last + 1, points.shape[1] + 1):
            self._floor(alpha, e)
        return np.log(alpha[lengths, np.arange(len(words))])

    def forward_long(self, word: str) -> np.ndarray:
        """forward of one word of any length."""
        points = np.frombuffer((WORD_START + word).encode("utf-32-le"), np.uint32)
        ends = self.lattice.spans(points)
        alpha = np.zeros((len(points) + 1, len(self.model.languages)))
        for end in range(1, len(points) + 1):
            ways = [alpha[end - 1] + np.log(FLOOR), *(alpha[start] + np.log(self.model.probabilities[i]) for start, i in ends.get(end, ()))]
            alpha[end] = np.logaddexp.reduce(ways)
        return alpha[-1]

    @staticmethod
    def _floor(alpha: np.ndarray, end: int) -> None:
        alpha[end] += alpha[end - 1] * FLOOR

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """For each text the language, its posterior under equal priors, and the mean log probability of a letter."""
        langs = self.model.languages
        if not langs:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        pieces = [words_of(t) if t else [] for t in texts]
        if len(self.index) * len(langs) > CACHE_CELLS:
            self.index, self.table = {}, self.table[:0]
        short = [[w for w in p if len(w) <= SHORT] for p in pieces]
        fresh = sorted(set().union(*short) - self.index.keys()) if short else []
        parts = [self.table]
        for i in range(0, len(fresh), 20_000):
            parts.append(self.forward(fresh[i : i + 20_000]))
        self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh))))
        self.table = np.concatenate(parts)
        names, scores, means = [], [], []
        for p, q in zip(pieces, short):
            if not p:
                names.append(UNDETERMINED)
                scores.append(0.0)
                means.append(0.0)
                continue
            total = self.table[np.fromiter(map(self.index.__getitem__, q), np.int64, len(q))].sum(0)
            if len(q) < len(p):
                total = total + sum(self.forward_long(w) * n for w, n in sorted(Counter(w for w in p if len(w) > SHORT).items()))
            odds = np.exp(total - total.max())
            best = int(total.argmax())
            names.append(langs[best])
            scores.append(float(odds[best] / odds.sum()))
            means.append(float(total[best]) / sum(map(len, p)))
        return names, scores, means


def most_of_each(sizes: list[int], max_docs: int) -> float:
    """The most rows of one language, for about max_docs of all; what rare languages leave goes to the others."""
    for i, n in enumerate(sorted(sizes)):
        if n > (fair := max_docs / (len(sizes) - i)):
            return max(fair, LEAST)
        max_docs -= n
    return float("inf")


def fit(labelled: DataFrame, vocab_path: str, text: str, lang: str, key: str, max_docs: int) -> Model:
    """Piece counts of at most about max_docs labelled rows, chosen by a hash of their key and text.

    Languages have equal parts in them, and those with fewer rows than their part have all, so that none is lost
    in a large table; with very many languages each still has about LEAST.
    The pieces of a training word are those of the vocabulary's own segmentation. What reaches the driver is
    one count per piece and language, which the vocabulary bounds.
    """
    labelled = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("k")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    most = most_of_each(list(sizes.values()), max_docs)
    sample = labelled
    if below := [F.lit(x) for name, n in sorted(sizes.items()) if n > most for x in (name, int(most / n * HASHES))]:
        limit = F.try_element_at(F.create_map(*below), F.col("lang"))
        sample = labelled.where(limit.isNull() | (F.pmod(F.xxhash64("k", "text"), F.lit(HASHES)) < limit))

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocab_path)
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, group in batch.groupby("lang"):
                words = Counter()
                for t in group["text"]:
                    words.update(words_of(t))
                own = found.setdefault(name, np.zeros(model.get_piece_size(), np.int64))
                for ids, times in zip(model.encode(list(words), num_threads=1), words.values()):
                    np.add.at(own, ids, times)
        for name, own in found.items():
            ids = np.flatnonzero(own)
            yield pd.DataFrame({"lang": name, "piece": ids, "n": own[ids]})

    rows = sample.mapInPandas(counts, "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(rows["lang"]))
    pieces = load_pieces(vocab_path)
    c = np.zeros((len(pieces), len(langs)))
    c[rows["piece"].to_numpy(int), [langs.index(x) for x in rows["lang"]]] = rows["n"]
    usable = np.array([bool(p) for p in pieces])[:, None]
    p = (c + SMOOTHING) * usable
    return Model(langs, vocab_path, p / p.sum(0, keepdims=True) if langs else p)


def predicted(text: Column | str, model: Model) -> Column:
    """Struct column (lang_pred, score, per_letter) of a text column."""

    @F.pandas_udf(SCHEMA)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for texts in batches:
            names, scores, means = [], [], []
            for i in range(0, len(texts), 200):
                a, b, c = scorer.predict([None if t is None else str(t) for t in texts.iloc[i : i + 200]])
                names += a
                scores += b
                means += c
            yield pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": pd.Series(scores, dtype=float), "per_letter": pd.Series(means, dtype=float)})

    return predict(text)


def held_out(key: str) -> Column:
    """True for the rows that no model of this operator learns from; a null key is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4)) == 2, F.lit(False))


def train_split(docs: DataFrame, vocab_path: str, text: str = "text", lang: str = "lang", key: str = "doc_id", max_docs: int = 20_000) -> Model:
    """The model learned from docs without their held-out rows; rows without a key are not learned from."""
    ship(docs.sparkSession)
    return fit(docs.where(F.col(key).isNotNull() & ~held_out(key)), vocab_path, text, lang, key, max_docs)


def identify(docs: DataFrame, vocab_path: str, text: str = "text", lang: str = "lang", key: str = "doc_id", max_docs: int = 20_000) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one for every row of docs.

    Null, empty and letterless texts are `und` with score 0; so is everything if no row has a language.
    Equal scores go to the language first in code-point order. Repeated rows get equal answers; extra
    columns are ignored. Whole texts are read; the score is the posterior under equal priors.
    """
    model = train_split(docs, vocab_path, text, lang, key, max_docs)
    rows = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), predicted(F.col(text), model).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, vocab_path: str, text: str = "text", lang: str = "lang", key: str = "doc_id", max_docs: int = 20_000, least: float = 0.5) -> DataFrame:
    """docs, with all their columns, without rows that are `und`, whose best language scores below least, or whose
    letters are less likely than LEAST_PER_LETTER on average even in it, such as texts in a script not learned."""
    from tickloom.llm.common import free_name

    model = train_split(docs, vocab_path, text, lang, key, max_docs)
    own = free_name(docs, "identified")
    sure = (F.col(own)["lang_pred"] != UNDETERMINED) & (F.col(own)["score"] >= least) & (F.col(own)["per_letter"] >= LEAST_PER_LETTER)
    return docs.withColumn(own, predicted(F.col(text), model)).where(sure).drop(own)
