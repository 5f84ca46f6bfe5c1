"""Hashed five-word shingles of whole texts, for batches of texts at a time."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import xxhash

WORDS = re.compile(r"\w+")
SIZE = 5
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
S33 = np.uint64(33)
#: Word hashes that a worker keeps.
CACHE_ENTRIES = 300_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> S33)) * M1
    x = (x ^ (x >> S33)) * M2
    return x ^ (x >> S33)


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


class Shingler:
    def __init__(self):
        self.cache: dict[str, int] = {}

    def hashed_words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts one after another, and the number of words of each."""
        words = [WORDS.findall(t.lower()) if t else [] for t in texts]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        for w in set().union(*words) - self.cache.keys() if words else ():
            self.cache[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.fromiter(map(self.cache.__getitem__, chain.from_iterable(words)), np.uint64, int(sizes.sum()))
        return flat, sizes

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of each text; a text of one to four words is one shingle."""
        flat, sizes = self.hashed_words(texts)
        with np.errstate(over="ignore"):
            h = np.zeros(max(0, len(flat) - SIZE + 1), np.uint64)
            for j in range(SIZE):
                h = mix(h * M2 + flat[j : j + len(h)])
            out, at = [], 0
            for n in sizes.tolist():
                if n >= SIZE:
                    out.append(distinct(h[at : at + n - SIZE + 1]))
                elif n:
                    one = np.array([n], np.uint64)
                    for j in range(n):
                        one = mix(one * M2 + flat[at + j])
                    out.append(one)
                else:
                    out.append(np.zeros(0, np.uint64))
                at += n
        return out


def pack(values: np.ndarray) -> bytes:
    """Sorted distinct hashes, whole."""
    return values.astype("<u8").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return both / (len(a) + len(b) - both)
