"""Toxicity with a bidirectional gated recurrent network over words and their characters.

A word enters as the embedding of the word and the mean embedding of its character four-grams. Two gated
recurrent layers read a window of words in both directions, attention pools their states, and a logistic unit
scores the window. A text scores as its highest window; windows overlap by half and cover the whole text. The
network is trained in numpy, on the windows that currently score highest in each labelled text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialize, scratch
from tickloom.llm.shingles import WORDS

WINDOW, STEP = 32, 16
HIDDEN, WIDTH, GRAM = 8, 8, 4
#: Entries of the vocabularies, learned from the training texts, and in how many of them an entry must occur.
WORD_LIMIT, GRAM_LIMIT, LEAST_TEXTS = 20_000, 30_000, 4
#: Labelled texts of each class to train on, at most about this many, and bytes of all of them.
MAX_DOCS, MAX_BYTES = 2_500, 48_000_000
#: Values of the hash that draws them.
HASHES = 1 << 53
EPOCHS, BATCH, RATE = 6, 128, 0.01
#: Few texts are gone over more often, until there were this many steps.
LEAST_STEPS = 200
CACHE_ENTRIES = 150_000


def terms(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def grams(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + GRAM] for i in range(max(1, len(w) - GRAM + 1))]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def telling(names: list[str], counts: np.ndarray, sizes: dict[int, int], limit: int) -> tuple[dict[str, int], np.ndarray]:
    """A vocabulary of the commonest entries (from 1; 0 is unknown) and their shrunk log odds of label 1.

    counts has a row per label: in how many texts each of names occurs.
    """
    total = counts.sum(0)
    chosen = sorted(np.flatnonzero(total >= LEAST_TEXTS).tolist(), key=lambda i: (-total[i], names[i]))[:limit]
    odds = [0.0]
    base = sizes[1] / max(1, sizes[0] + sizes[1])
    for i in chosen:
        share = (counts[1, i] + 4 * base) / (total[i] + 4)
        odds.append(float(np.clip(math.log(share / (1 - share)) - math.log(base / (1 - base)), -4, 4)) if 0 < base < 1 else 0.0)
    return {names[i]: n + 1 for n, i in enumerate(chosen)}, np.array(odds)


def occurrences(texts: list[np.ndarray], labels: list[int], size: int) -> np.ndarray:
    """In how many texts of label 0 and 1 each id occurs."""
    counts = np.zeros((2, size), np.int64)
    for ids, y in zip(texts, labels):
        counts[y, np.unique(ids)] += 1
    return counts


@dataclass
class Network:
    words: dict[str, int]
    grams: dict[str, int]
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(words: dict[str, int], word_odds: np.ndarray, gram_ids: dict[str, int], gram_odds: np.ndarray, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        p = {"ew": rng.normal(0, 0.1, (len(word_odds), WIDTH)), "eg": rng.normal(0, 0.1, (len(gram_odds), WIDTH))}
        p["ew"][:, 0] = word_odds
        p["eg"][:, 0] = 2 * gram_odds
        for d in "fb":
            p["x" + d] = rng.normal(0, 0.3, (2 * WIDTH, 3 * HIDDEN))
            p["h" + d] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
            p["c" + d] = np.zeros(3 * HIDDEN)
        p["att"] = rng.normal(0, 0.3, 2 * HIDDEN)
        p["out"] = rng.normal(0, 0.3, 2 * HIDDEN)
        p["bias"] = np.array([-1.0])
        return Network(words, gram_ids, p)

    def ids(self, vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word id, flat gram ids, first gram) of each word."""
        found = [[self.grams.get(g, 0) for g in grams(w)] for w in vocabulary]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
        return np.array([self.words.get(w, 0) for w in vocabulary], np.int64), flat, np.cumsum(sizes) - sizes

    def inputs(self, ids: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        word, flat, first = ids
        if not len(word):
            return np.zeros((0, 2 * WIDTH))
        size = np.diff(np.append(first, len(flat)))[:, None]
        return np.hstack([self.p["ew"][word], np.add.reduceat(self.p["eg"][flat], first, axis=0) / size])

    def run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States of one direction; x are projected inputs (windows, steps, 3 x HIDDEN)."""
        n, steps = mask.shape
        h = np.zeros((n, HIDDEN), x.dtype)
        out = np.empty((n, steps, HIDDEN), x.dtype)
        wh, a = self.p["h" + d].astype(x.dtype, copy=False), 2 * HIDDEN
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            gh = h @ wh
            gate = sigmoid(x[:, t, :a] + gh[:, :a])
            r, z = gate[:, :HIDDEN], gate[:, HIDDEN:]
            new = np.tanh(x[:, t, a:] + r * gh[:, a:])
            m = mask[:, t, None]
            after = np.where(m, new + z * (h - new), h)
            if keep is not None:
                keep.append((t, h, r, z, new, gh[:, a:], m))
            h = after
            out[:, t] = h
        return out

    def pool(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        e = np.where(mask, states @ self.p["att"].astype(states.dtype, copy=False), -np.inf)
        e = np.exp(e - e.max(1, keepdims=True))
        e /= e.sum(1, keepdims=True)
        pooled = (e[:, :, None] * states).sum(1)
        return e, pooled, pooled @ self.p["out"] + self.p["bias"][0]

    def step(self, windows: np.ndarray, mask: np.ndarray, ids: tuple, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted log loss; windows hold row numbers into ids, -1 where padded."""
        p = self.p
        x = self.inputs(ids)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        flat = np.where(mask, windows, 0)
        kept: dict[str, list] = {"f": [], "b": []}
        states = [self.run(d, (x @ p["x" + d] + p["c" + d])[flat], mask, kept[d]) for d in "fb"]
        both = np.concatenate(states, axis=2)
        e, pooled, logit = self.pool(both, mask)
        dl = (sigmoid(logit) - label) * weight / len(label)
        g["out"], g["bias"] = pooled.T @ dl, np.array([dl.sum()])
        dp = dl[:, None] * p["out"]
        de = (both * dp[:, None, :]).sum(2)
        da = e * (de - (e * de).sum(1, keepdims=True))
        g["att"] = (both * da[:, :, None]).sum((0, 1))
        dboth = e[:, :, None] * dp[:, None, :] + da[:, :, None] * p["att"]
        dx = np.zeros_like(x)
        for i, d in enumerate("fb"):
            ds, carry = dboth[:, :, i * HIDDEN : (i + 1) * HIDDEN], np.zeros((len(label), HIDDEN))
            dproj = np.zeros((*mask.shape, 3 * HIDDEN))
            for t, h, r, z, new, ghn, m in reversed(kept[d]):
                dh = ds[:, t] + carry
                live = dh * m
                dn = live * (1 - z) * (1 - new * new)
                dz = live * (h - new) * z * (1 - z)
                dr = dn * ghn * r * (1 - r)
                dgh = np.hstack([dr, dz, dn * r])
                dproj[:, t] = np.hstack([dr, dz, dn])
                g["h" + d] += h.T @ dgh
                carry = live * z + dh * ~m + dgh @ p["h" + d].T
            rows, dproj = flat[mask], dproj[mask]
            g["c" + d] = dproj.sum(0)
            total = np.zeros((len(x), 3 * HIDDEN))
            np.add.at(total, rows, dproj)
            g["x" + d] = x.T @ total
            dx += total @ p["x" + d].T
        word, grams_flat, first = ids
        np.add.at(g["ew"], word, dx[:, :WIDTH])
        size = np.diff(np.append(first, len(grams_flat)))
        np.add.at(g["eg"], grams_flat, np.repeat(dx[:, WIDTH:] / size[:, None], size, axis=0))
        return g


def pieces(ids: tuple, size: int = 10_000) -> Iterator[tuple[int, tuple]]:
    """Parts of Network.ids with the number of their first word: arrays over all words at once are large."""
    word, flat, first = ids
    for lo in range(0, len(word), size):
        hi = min(lo + size, len(word))
        end = first[hi] if hi < len(word) else len(flat)
        yield lo, (word[lo:hi], flat[first[lo] : end], first[lo:hi] - first[lo])


def windows_of(n: int) -> np.ndarray:
    """Positions of the words of each window of a text of n words; -1 beyond its end."""
    starts = np.arange(0, max(1, n - WINDOW + STEP), STEP) if n > WINDOW else np.zeros(min(1, n), int)
    at = starts[:, None] + np.arange(WINDOW)
    return np.where(at < n, at, -1)


def train(texts: list[str], labels: list[int]) -> Network:
    """The network learned from these texts (0 or 1 each); Adam, the same for the same input."""
    vocabulary: dict[str, int] = {}
    words = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in terms(t)], np.int32) for t in texts]
    sizes = {c: sum(y == c for y in labels) for c in (0, 1)}
    spelling: dict[str, int] = {}
    spelled = [np.array([spelling.setdefault(g, len(spelling)) for g in grams(w)], np.int32) for w in vocabulary]
    in_texts = (np.concatenate([spelled[w] for w in np.unique(t).tolist()] or [np.zeros(0, np.int32)]) for t in words)
    by_word = telling(list(vocabulary), occurrences(words, labels, len(vocabulary)), sizes, WORD_LIMIT)
    by_gram = telling(list(spelling), occurrences(in_texts, labels, len(spelling)), sizes, GRAM_LIMIT)
    del spelled, spelling
    net = Network.fresh(*by_word, *by_gram)
    if not sizes[0] or not sizes[1]:
        net.p["out"][:] = 0
        net.p["bias"][0] = 4.0 if sizes[1] else -4.0
        return net
    ids = net.ids(list(vocabulary))
    rows, owner = [], []
    for d, w in enumerate(words):
        if len(w):
            win = windows_of(len(w))
            rows.append(np.where(win >= 0, w[win], -1).astype(np.int32))
            owner.append(np.full(len(win), d))
    rows, owner, label = np.concatenate(rows), np.concatenate(owner), np.array(labels, float)
    # beside its highest window, a clean text gives one more on average
    often = 1 / np.bincount(owner, minlength=len(texts))[owner]
    balance = np.where(label == 1, len(label) / (2 * sizes[1]), len(label) / (2 * sizes[0]))
    rng = np.random.default_rng(5)
    m, v, n = {k: np.zeros_like(x) for k, x in net.p.items()}, {k: np.zeros_like(x) for k, x in net.p.items()}, 0
    logits = np.zeros(len(rows))
    steps = -(-len(texts) * 2 // BATCH)
    for epoch in range(max(EPOCHS, -(-LEAST_STEPS // steps))):
        if epoch:
            table = Scorer.projections(net, ids)
            logits = np.concatenate([Scorer.logits(net, table, rows[i : i + 4096]) for i in range(0, len(rows), 4096)])
        order = np.lexsort((-logits, owner))
        best = order[np.append(True, owner[order][1:] != owner[order][:-1])]
        clean = np.flatnonzero((label[owner] == 0) & (rng.random(len(owner)) < often))
        chosen = rng.permutation(np.concatenate([best, clean]))
        for i in range(0, len(chosen), BATCH):
            b = rows[chosen[i : i + BATCH]]
            used, local = np.unique(b, return_inverse=True)
            local = local.reshape(b.shape) - int(used[0] == -1)
            used = used[used >= 0]
            first = ids[2]
            ends = np.append(first[1:], len(ids[1]))
            some = [ids[1][first[u] : ends[u]] for u in used]
            length = np.array([len(s) for s in some])
            part = (ids[0][used], np.concatenate(some), np.cumsum(length) - length)
            y = owner[chosen[i : i + BATCH]]
            grads = net.step(local, b >= 0, part, label[y], balance[y])
            n += 1
            for k, g in grads.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                net.p[k] = net.p[k] - RATE * (m[k] / (1 - 0.9**n)) / (np.sqrt(v[k] / (1 - 0.999**n)) + 1e-8)
    return net


class Scorer:
    """Scores texts; keeps projected inputs of words it has seen."""

    def __init__(self, net: Network):
        self.net, self.index = net, {}
        self.table = np.zeros((0, 6 * HIDDEN), np.float32)

    @staticmethod
    def projections(net: Network, ids: tuple) -> np.ndarray:
        out = np.empty((len(ids[0]), 6 * HIDDEN), np.float32)
        for lo, part in pieces(ids):
            x = net.inputs(part)
            out[lo : lo + len(x)] = np.hstack([x @ net.p["x" + d] + net.p["c" + d] for d in "fb"])
        return out

    @staticmethod
    def logits(net: Network, table: np.ndarray, windows: np.ndarray) -> np.ndarray:
        mask = windows >= 0
        x = table[np.where(mask, windows, 0)]
        both = np.concatenate([net.run("f", x[:, :, : 3 * HIDDEN], mask), net.run("b", x[:, :, 3 * HIDDEN :], mask)], axis=2)
        return net.pool(both, mask)[2]

    def scores(self, texts: list[str | None]) -> list[float]:
        words = [terms(t) if t else [] for t in texts]
        if len(self.index) > CACHE_ENTRIES:
            self.index, self.table = {}, self.table[:0]
        fresh = sorted(set().union(*words) - self.index.keys()) if words else []
        self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh))))
        self.table = np.concatenate([self.table, self.projections(self.net, self.net.ids(fresh))]) if fresh else self.table
        out, held, owner, size = np.zeros(len(texts)), [], [], 0

        def done() -> None:
            if held:
                np.maximum.at(out, np.concatenate(owner), sigmoid(self.logits(self.net, self.table, np.concatenate(held))))
                held.clear()
                owner.clear()

        for d, w in enumerate(words):
            at = np.fromiter(map(self.index.__getitem__, w), np.int64, len(w))
            win = windows_of(len(w))
            for i in range(0, len(win), 2048):
                part = win[i : i + 2048]
                held.append(np.where(part >= 0, at[part], -1))
                owner.append(np.full(len(part), d))
                size += len(part)
                if size >= 2048:
                    done()
                    size = 0
        done()
        return out.tolist()


def score(text: Column, net: Network) -> Column:
    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(net)
        for texts in batches:
            out: list[float] = []
            for i in range(0, len(texts), 100):
                out += scorer.scores([None if t is None else str(t) for t in texts.iloc[i : i + 100]])
            yield pd.Series(out, dtype=float)

    return rate(text)


def held_out(key: str) -> Column:
    """True for the rows whose labels are never learned from; a null key is never held out (and has no label)."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES) -> Network:
    """Train on at most about max_docs labelled rows of each class and max_bytes in all, chosen by a hash of their key.

    Of several texts of one key the smallest is taken; texts are read whole.
    """
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y in (0, 1)").where(~held_out("k")).groupBy("k").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    place = F.pmod(F.xxhash64("k"), F.lit(HASHES))
    limit = {y: int(min(1.0, max_docs / max(1, sizes.get(y, 0))) * HASHES) for y in (0, 1)}
    chosen = known.where(place < F.when(F.col("y") == 1, F.lit(limit[1])).otherwise(F.lit(limit[0])))
    with scratch(docs.sparkSession):
        texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null")
        rows = materialize(texts.join(F.broadcast(chosen), "k").groupBy("k", "y").agg(F.min("t").alias("t")))
        total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        if total > max_bytes:
            rows = rows.where(F.pmod(F.xxhash64("k", F.lit("again")), F.lit(HASHES)) < int(max_bytes / total * HASHES))
        found = rows.toPandas().sort_values(["k", "t"])
    return train(found["t"].tolist(), found["y"].tolist())


def rate_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one for every row of docs.

    Null, empty and wordless texts score 0. Without labels of both classes every other text scores the class
    that there is, or nearly 0 without any. Repeated rows score alike; rows with several labels count as toxic if
    one says so; extra columns are ignored. Texts are read whole, in overlapping windows.
    """
    net = fit(docs, labels, text, key, label)
    rows = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), score(F.col(text), net).alias("score"))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
