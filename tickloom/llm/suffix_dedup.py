"""Suffix-array dedup by threshold-bounded interval expansion.

What is asked: the byte positions whose next `length` bytes also start anywhere else in the table.

1. Every window has a core of about half its length, chosen by mod-sampling: the place of the smallest hash of its
   short grams (leftmost of equals), modulo the number of places that a core has. A run of positions with one core is
   a piece, and the core's hash is the piece's key. Equal windows therefore always meet under one key, wherever they
   are, and a key that comes once is done.
2. Pieces of keys that come more often are collapsed by the hash of their bytes; one copy of each travels, with
   its number of copies as weight.
3. The copies of whole keys are packed into blocks of bounded size. In each block a suffix order and its
   Burrows-Wheeler transform are built, and intervals are expanded breadth-first by backward extension: strings of
   growing length claim the right boundaries of their intervals, which are the common prefixes by increasing
   value, and the expansion stops at `length`. Boundaries never claimed join suffixes that share `length` bytes.
4. A key with more than KEY_REGIONS different pieces (a passage that very many texts share, at its ends) is cut
   into smaller pieces and then into its single positions, which are collapsed by hash in the same way before they
   reach a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, lasting, materialize, scratch
from tickloom.llm.shingles import mix

LENGTH = 400
#: Bytes of the grams by which a core is chosen.
GRAM = 19
#: Distances to the core that the smaller pieces of keys with very many pieces cover.
SMALL_REACH = 16
#: Bytes of texts, or positions of a longer one, that are cut at a time: what a processor's cache holds.
SEGMENT = 1 << 15
#: Different pieces of one key that a block takes together.
KEY_REGIONS = 500
#: Bytes of pieces that make a block.
BLOCK = 400_000
#: Length of the marked windows, and how many successive windows hold one that is marked (the one with the smallest
#: hash of its first gram): a passage of both together less one is marked alike in every text that has it.
MARK, MARK_STEP = 200, 63
INDEX = np.uint64((1 << 18) - 1)

_rng = np.random.default_rng(20_240_229)
TABLES = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = np.full(n, np.uint64(base), np.uint64)
        x[0] = 1
        return np.multiply.accumulate(x)


class Rolling:
    """Hashes of any ranges of a byte array, from prefix sums modulo 2**64."""

    SIZE = 1 << 18
    POWERS: list[tuple[np.ndarray, np.ndarray]] = []

    def __init__(self, data: np.ndarray, which: int):
        if not self.POWERS:
            self.POWERS.extend((_powers(b, self.SIZE), _powers(pow(b, -1, 1 << 64), self.SIZE)) for b in BASES)
        up, self.down = self.POWERS[which]
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(TABLES[which][data] * up[: len(data)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        with np.errstate(over="ignore"):
            return mix((self.sums[size:] - self.sums[:-size]) * self.down[:n])


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every window of this size."""
    n = len(x) - size + 1
    blocks = -(-len(x) // size)
    wide = np.full(blocks * size, np.iinfo(np.uint64).max, np.uint64)
    wide[: len(x)] = x
    wide = wide.reshape(blocks, size)
    forward = np.minimum.accumulate(wide, axis=1).ravel()
    backward = np.minimum.accumulate(wide[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[size - 1 : size - 1 + n])


def core_of(length: int) -> int:
    """Bytes of a core: so many that grams, cores and windows fit as mod-sampling wants it for few different cores."""
    return (length + GRAM + 1) // 2


def cores(grams: np.ndarray, length: int) -> np.ndarray:
    """Where the core of each window starts; grams are the hashes of all grams."""
    low = sliding_min((grams & ~INDEX) | np.arange(len(grams), dtype=np.uint64), length - GRAM + 1) & INDEX
    at = np.arange(len(low))
    return at + (low.astype(np.int64) - at) % (length - core_of(length) + 1)


def cut_together(texts: list[bytes], length: int = LENGTH, marked: bool = False) -> tuple[np.ndarray, ...]:
    """(text, start, positions, key, digest) of the pieces of texts of at most 2 x SEGMENT bytes together, and
    (text, hash) of their marked windows; in the order of the texts."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = ends[owner] - np.arange(len(data))
    one, two = Rolling(data, 0), Rolling(data, 1)
    none = np.zeros(0, np.int64)
    pieces, marks = (none, none, none, none.astype(np.uint64), none.astype(np.uint64)), (none, none.astype(np.uint64))
    if len(data) < min(length, MARK):
        return *pieces, *marks
    grams = one.windows(GRAM)
    if marked and len(data) >= MARK + MARK_STEP - 1:
        n = len(data) - MARK + 1
        chosen = sliding_min((grams[:n] & ~INDEX) | np.arange(n, dtype=np.uint64), MARK_STEP)
        at = np.flatnonzero(left[: len(chosen)] >= MARK + MARK_STEP - 1)
        chosen, whose = (chosen[at] & INDEX).astype(np.int64), owner[at]
        new = np.append(True, chosen[1:] != chosen[:-1])[: len(at)]
        whose, chosen = whose[new], one.ranges(chosen[new], chosen[new] + MARK)
        order = np.lexsort((chosen, whose))
        whose, chosen = whose[order], chosen[order]
        once = np.append(True, (whose[1:] != whose[:-1]) | (chosen[1:] != chosen[:-1]))[: len(whose)]
        marks = whose[once], chosen[once]
    if len(data) >= length:
        core = cores(grams, length)
        at = np.flatnonzero(left[: len(core)] >= length)
        core, whose = core[at], owner[at]
        new = np.append(True, (core[1:] != core[:-1]) | (whose[1:] != whose[:-1]))[: len(at)]
        core, first = core[new], at[new]
        count = np.diff(np.append(np.flatnonzero(new), len(at)))
        whose = whose[new]
        pieces = whose, first - (ends - sizes)[whose], count, one.ranges(core, core + core_of(length)), two.ranges(first, first + count - 1 + length)
    return *pieces, *marks


def cut_text(data: bytes, length: int = LENGTH, marked: bool = False) -> tuple[np.ndarray, ...]:
    """(start, positions, key, digest) of the pieces of one text of any length, and the hashes of its marked windows."""
    found = [cut_together([data[at : at + SEGMENT + max(length, MARK + MARK_STEP - 1) - 1]], length, marked) for at in range(0, max(1, len(data) - min(length, MARK) + 1), SEGMENT)]
    out = [[], [], [], [], []]
    for nth, (_, start, count, key, digest, _, mark) in enumerate(found):
        own = start < SEGMENT
        for o, x in zip(out, (start[own] + nth * SEGMENT, np.minimum(count[own], SEGMENT - start[own]), key[own], digest[own], mark)):
            o.append(x)
    return *map(np.concatenate, out[:4]), np.unique(np.concatenate(out[4]))


def cut_all(texts: list[bytes], length: int, marked: bool) -> Iterator[tuple[int, tuple[list[int], ...], tuple[np.ndarray, ...]]]:
    """(number of texts, pieces and marks of each, their values) of successive texts."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (size == 0 or size + len(texts[upto]) <= SEGMENT):
            size += len(texts[upto])
            upto += 1
        if size > SEGMENT:
            *pieces, mark = cut_text(texts[at], length, marked)
            yield 1, ([len(pieces[0])], [len(mark)]), (*pieces, mark)
        else:
            whose, *pieces, marked_in, mark = cut_together(texts[at:upto], length, marked)
            yield upto - at, tuple(np.bincount(x, minlength=upto - at).tolist() for x in (whose, marked_in)), (*pieces, mark)
        at = upto


class Suffixes:
    """The suffixes of some byte strings in an order of their first `length` bytes, and the expansion over them.

    Each string ends with a byte that UTF-8 does not have; a suffix that ends is like no other.
    """

    #: Bytes in the first sort key, and the length (at most) of the strings the expansion starts from.
    PACKED, SEED, END = 8, 32, 255

    def __init__(self, strings: list[bytes], length: int):
        self.length = length
        sizes = np.array([len(s) for s in strings])
        ends = np.cumsum(sizes + 1) - 1
        self.n = int(ends[-1]) + 1
        self.text = np.frombuffer(bytes([self.END]).join([*strings, b""]), np.uint8)
        self.starts = ends - sizes
        self.which = np.repeat(np.arange(len(strings)), sizes + 1)
        self.left = ends[self.which] - np.arange(self.n)  # bytes before the string's end
        self._sort()

    def _sort(self) -> None:
        """Order by PACKED bytes, then by twice as many each time; only groups that are still tied are sorted.

        A suffix that ends within the bytes compared is a group of its own, so ties never reach beyond an end.
        """
        n = self.n
        key = np.full(n + self.PACKED, self.END, np.uint64)
        key[:n] = self.text
        size = 1
        while size < self.PACKED:
            key[:-size] = (key[:-size] << np.uint64(8 * size)) | key[size:]
            size *= 2
        key = key[:n]
        order = np.argsort(key)
        ordered = key[order]
        new = np.append(True, ordered[1:] != ordered[:-1]) | (self.left[order] < self.PACKED)
        rank = np.empty(n, np.int64)
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        self.seed, self.bounds = self.PACKED, new.copy()
        h = self.PACKED
        while h < self.length:
            if h <= self.SEED:
                self.seed, self.bounds = h, new.copy()
            first = np.flatnonzero(new)
            members = np.diff(np.append(first, n))
            at = np.flatnonzero(np.repeat(members > 1, members))
            if not len(at):
                break
            tied = order[at]
            pair = rank[tied] * n + rank[tied + h]
            sort = np.argsort(pair)
            tied, pair = tied[sort], pair[sort]
            fresh = np.append(True, pair[1:] != pair[:-1])
            order[at] = tied
            new[at[fresh]] = True
            rank[tied] = at[fresh][np.cumsum(fresh) - 1]
            h *= 2
        self.order = order
        self.place = np.empty(n, np.int64)
        self.place[order] = np.arange(n)

    def expand(self) -> np.ndarray:
        """True where a suffix does not share `length` bytes with the one before it in the order.

        Starts from the intervals of all strings of SEED bytes (fewer, if they end); the strings grow by one byte
        to the left each step. An interval whose right boundary is claimed already isn't followed.
        """
        n = self.n
        claimed = np.append(self.bounds, True)
        if claimed.all():
            return claimed[:n]
        before = self.order - 1
        symbol = np.where(before >= 0, self.text[before], self.END).astype(np.int64)
        target = self.place[before].astype(np.int32)
        runs = np.append(np.flatnonzero(symbol[1:] != symbol[:-1]) + 1, n)
        same_until = np.repeat(runs, np.diff(np.append(0, runs)))
        lo = np.flatnonzero(self.bounds)
        hi = np.append(lo[1:], n)
        for _ in range(self.seed, self.length):
            # an interval with one byte before all its suffixes has one child, whose ends are known at once
            whole = same_until[lo] >= hi
            start, last = target[lo[whole]], target[hi[whole] - 1]
            whole[whole] = last - start == hi[whole] - lo[whole] - 1
            use = whole & (symbol[lo] != self.END)
            start = target[lo[use]]
            end = start + (hi[use] - lo[use])
            lo, hi = lo[~whole], hi[~whole]
            if len(lo):
                size = hi - lo
                owner = np.repeat(np.arange(len(lo)), size)
                rows = np.arange(len(owner)) + np.repeat(lo - (np.cumsum(size) - size), size)
                s = symbol[rows]
                inside = s != self.END
                to, owner, s = target[rows[inside]], owner[inside], s[inside]
                sort = np.argsort(to)
                to, owner, s = to[sort], owner[sort], s[sort]
                first = np.append(True, (owner[1:] != owner[:-1]) | (s[1:] != s[:-1]))[: len(to)]
                start = np.concatenate([start, to[first]])
                end = np.concatenate([end, to[np.append(first[1:], True)[: len(to)]] + 1])
            free = ~claimed[end]
            lo, hi = start[free], end[free]
            claimed[hi] = True
            if not len(lo):
                break
        return claimed[:n]


def repeated(strings: list[bytes], weights: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first, last) of the runs of offsets at which `length` bytes start that start elsewhere too, or in a
    copy of the string."""
    if not strings:
        return (np.zeros(0, np.int64),) * 3
    suffixes = Suffixes(strings, length)
    group = np.cumsum(suffixes.expand()) - 1
    whole = suffixes.left[suffixes.order] >= length
    times = np.bincount(group, np.where(whole, weights[suffixes.which[suffixes.order]], 0))
    hit = suffixes.order[whole & (times[group] >= 2)]
    hit.sort()
    new = np.flatnonzero(np.append(True, np.diff(hit) > 1))[: len(hit)]  # an end lies between strings
    first, last = hit[new], hit[np.append(new[1:], len(hit))[: len(new)] - 1]
    which = suffixes.which[first]
    return which, first - suffixes.starts[which], last - suffixes.starts[which]


#: More than a text has bytes: parts the positions of successive rows.
APART = 1 << 40


def merged(hits: pa.ListArray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the runs of each row's hits (at, and low and high relative to it), in order; runs of which
    the second starts at most `reach` after the first ends are one."""
    each = hits.flatten()
    low, high = each.field("low"), each.field("high")
    size = low.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(hits)), hits.value_lengths().to_numpy(zero_copy_only=False))
    base = np.repeat(row * APART + each.field("at").to_numpy(zero_copy_only=False), size)
    low, high = base + low.flatten().to_numpy(zero_copy_only=False), base + high.flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(low)
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.append(True, low[1:] > high[:-1] + reach)[: len(low)]
    at = np.flatnonzero(new)
    first, last = low[at], high[np.append(at[1:], len(low))[: len(at)] - 1]
    return first // APART, first % APART, last % APART


def _lists(values: list[np.ndarray], kind: pa.DataType, sizes: list[int] | None = None) -> pa.ListArray:
    """A list of each of values, or of as many of all of them as sizes tell."""
    offsets = np.append(0, np.cumsum([len(v) for v in values] if sizes is None else sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*values, np.zeros(0, np.int64)]), kind))


def _cut(length: int, marked: bool) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for n, (pieces, marks), values in cut_all([t.encode() for t in batch.column("text").to_pylist()], length, marked):
                part = batch.slice(at, n)
                at += n
                lists = [_lists([v.view(np.int64)], pa.int64(), marks if i == 4 else pieces) for i, v in enumerate(values)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("node"), *lists], names=["doc_id", "node", "start", "positions", "key", "digest", "marks"])

    return cut


def _fetch(length: int) -> Callable:
    """The bytes of the wanted pieces of each text."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                data = text.encode()
                for at in range(0, len(wanted), 2000):
                    some = wanted[at : at + 2000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([w[c] for w in some], pa.int64()) for c in ("key", "digest", "copies")]
                        + [pa.array([w[c] for w in some], pa.bool_()) for c in ("many", "alone")]
                        + [pa.array([data[w["start"] : w["start"] + w["positions"] - 1 + length] for w in some], pa.binary())],
                        names=["key", "digest", "copies", "many", "alone", "bytes"],
                    )

    return fetch


def _expand(length: int) -> Callable:
    """Rows sorted by alone, key and digest come in; a block takes whole keys, each piece once. Keys with one piece
    only come in blocks of their own: their suffixes part early, and the expansion ends at once."""

    def done(held: list[tuple]) -> pa.RecordBatch:
        which, low, high = repeated([h[3] for h in held], np.array([h[2] for h in held]), length)
        sizes = np.bincount(which, minlength=len(held))
        some = np.flatnonzero(sizes).tolist()
        lists = [_lists([x], pa.int64(), sizes[some].tolist()) for x in (low, high)]
        return pa.RecordBatch.from_arrays([*(pa.array([held[i][c] for i in some], pa.int64()) for c in (0, 1)), *lists], names=["key", "digest", "low", "high"])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes, bool]] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "digest", "copies", "bytes", "alone"))):
                if held and row[:2] == held[-1][:2]:
                    continue
                if held and row[0] != held[-1][0] and (size >= BLOCK or row[4] != held[-1][4]):
                    yield done(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield done(held)

    return expand


def _parts(length: int, reach: int) -> Callable:
    """Cuts pieces into smaller ones that cover `reach` distances to the piece's core."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "digest", "copies", "at", "key2", "digest2", "bytes"]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for key, digest, copies, data in zip(*(batch.column(c).to_pylist() for c in ("key", "digest", "copies", "bytes"))):
                part = np.frombuffer(data, np.uint8)
                one, two = Rolling(part, 0), Rolling(part, 1)
                core = int(cores(one.windows(GRAM)[: length - GRAM + 1], length)[0])
                count = len(data) - length + 1
                band = (core - np.arange(count)) // reach
                first = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
                size = np.diff(np.append(first, count))
                near = band[first] * reach
                far = np.minimum(near + reach - 1, length - core_of(length))
                keys = mix(one.ranges(core - near, core - far + length) + band[first].astype(np.uint64)).view(np.int64)
                digests = two.ranges(first, first + size - 1 + length).view(np.int64)
                for c, v in zip(out, ([key] * len(first), [digest] * len(first), [copies] * len(first), first, keys, digests, [data[f : f + n - 1 + length] for f, n in zip(first.tolist(), size.tolist())])):
                    c.extend(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "bytes" else pa.int64()) for n, c in zip(names, out)], names=names)

    return cut


RUNS = "key bigint, digest bigint, low array<bigint>, high array<bigint>"


def _blocks(rows: DataFrame, length: int) -> DataFrame:
    dealt = rows.select("key", "digest", "copies", "bytes", "alone").repartition("key").sortWithinPartitions("alone", "key", "digest")
    return dealt.mapInArrow(_expand(length), RUNS)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, low, high = merged(batch.column("hits"), 1)
        sizes = np.bincount(row, minlength=batch.num_rows).tolist()
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("digest"), *(_lists([x], pa.int64(), sizes) for x in (low, high))], names=["key", "digest", "low", "high"])


def _slim(docs: DataFrame, text: str, key: str, least: int) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.unhex(F.md5(F.col(text))).alias("node"), F.col(text).alias("text")).where(F.octet_length("text") >= least)


def cut_texts(docs: DataFrame, text: str, key: str, length: int, marked: bool) -> DataFrame:
    """(doc_id, node, start, positions, key, digest, marks): the pieces of each text; node is the text's digest."""
    slim = _slim(docs, text, key, min(length, MARK) if marked else length)
    lists = ", ".join(f"{c} array<bigint>" for c in ("start", "positions", "key", "digest", "marks"))
    return slim.mapInArrow(_cut(length, marked), f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, node binary, {lists}")


def _first(*more: str) -> Column:
    """The row with the smallest key, null last, of a group."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *more)).alias("rep")


def repeats(docs: DataFrame, cut: DataFrame, text: str, key: str, length: int) -> DataFrame:
    """(node, rep, hits): for each text of docs with repeats the pieces (at, low, high) in which windows start that
    start elsewhere too, at low to high from the piece's start; rep is the smallest key of a row with that text. cut is
    a written table of cut_texts.

    Tables that joins read are written before, so that a key with very many rows can be split when it is joined.
    """
    again = materialize(cut.select(F.explode("key").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("key"))
    flat = cut.select("doc_id", "node", F.explode(F.arrays_zip("start", "positions", "key", "digest")).alias("p")).select("doc_id", "node", "p.*")
    shared = materialize(flat.join(again, "key"))
    regions = materialize(shared.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("copies"), F.first("positions").alias("positions"), _first("node", "start")))
    sizes = materialize(regions.groupBy("key").agg(F.count(F.lit(1)).alias("regions")))
    flags = (F.col("regions") > KEY_REGIONS).alias("many"), (F.col("regions") == 1).alias("alone")
    wanted = regions.join(sizes, "key").select("rep.doc_id", "rep.node", F.struct("key", "digest", "copies", *flags, F.col("rep.start").alias("start"), "positions").alias("w"))
    wanted = wanted.groupBy("doc_id", "node").agg(F.collect_list("w").alias("wanted")).withColumnRenamed("doc_id", "rep")
    fetched = _texts_of(docs, wanted, text, key, length).select("text", "wanted")
    fetched = materialize(fetched.mapInArrow(_fetch(length), "key bigint, digest bigint, copies bigint, many boolean, alone boolean, bytes binary"))
    found = _blocks(fetched.where("not many"), length)
    if fetched.where("many").limit(1).count():
        found = found.union(_split(fetched.where("many").select("key", "digest", "copies", "bytes").dropDuplicates(["key", "digest"]), length, SMALL_REACH))
    found = materialize(found)
    spots = shared.groupBy("node", F.col("start").alias("at"), "key", "digest").agg(_first())
    return spots.join(found, ["key", "digest"]).groupBy("node").agg(F.min("rep")["doc_id"].alias("rep"), F.collect_list(F.struct("at", "low", "high")).alias("hits"))


def _texts_of(docs: DataFrame, nodes: DataFrame, text: str, key: str, least: int) -> DataFrame:
    """nodes (node, rep, ...) with the text of a row that has them; more often than once if rows are repeated."""
    slim = _slim(docs, text, key, least).withColumnsRenamed({"node": "n", "doc_id": "d"})
    return slim.join(nodes, F.col("d").eqNullSafe(F.col("rep")) & (F.col("n") == F.col("node")))


def _split(hot: DataFrame, length: int, reach: int) -> DataFrame:
    """What _blocks gives, for keys with very many pieces: cut into smaller pieces, the equal ones collapsed.

    Keys that are still too many after that are cut into single positions, where all pieces of a key are equal
    (but for collisions of hashes, which are left to the blocks).
    """
    parts = materialize(hot.mapInArrow(_parts(length, reach), "key bigint, digest bigint, copies bigint, at bigint, key2 bigint, digest2 bigint, bytes binary"))
    again = materialize(parts.groupBy("key2").agg(F.sum("copies").alias("times")).where("times > 1").select("key2"))
    parts = materialize(parts.join(again, "key2"))
    regions = materialize(parts.groupBy(F.col("key2").alias("key"), F.col("digest2").alias("digest")).agg(F.sum("copies").alias("copies"), F.min("bytes").alias("bytes")))
    sizes = materialize(regions.groupBy("key").agg(F.count(F.lit(1)).alias("regions")))
    regions = materialize(regions.join(sizes, "key").withColumn("alone", F.col("regions") == 1))
    many = F.col("regions") > (KEY_REGIONS if reach > 1 else (1 << 62))
    found = _blocks(regions.where(~many), length)
    if regions.where(many).limit(1).count():
        found = found.union(_split(regions.where(many).select("key", "digest", "copies", "bytes"), length, 1))
    found = materialize(found.toDF("key2", "digest2", "low", "high"))
    hits = parts.select("key", "digest", "at", "key2", "digest2").join(found, ["key2", "digest2"])
    return hits.groupBy("key", "digest").agg(F.collect_list(F.struct("at", "low", "high")).alias("hits")).mapInArrow(_joined, RUNS)


def marked_passages(cut: DataFrame) -> DataFrame:
    """(node, shares_passage = 1): the texts of which a marked window stands in another row too."""
    marks = cut.select("node", F.explode("marks").alias("mark"))
    again = materialize(marks.groupBy("mark").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("mark"))
    return marks.join(again, "mark").select("node").distinct().withColumn("shares_passage", F.lit(1))


def _covered(batch: pa.RecordBatch, length: int) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Each row's text and its maximal byte spans covered by windows that start at the hits."""
    row, first, last = merged(batch.column("hits"), length)
    cuts = np.searchsorted(row, np.arange(batch.num_rows + 1)).tolist()
    spans = list(zip(first.tolist(), (last + length).tolist()))
    for i, text in enumerate(batch.column("text").to_pylist()):
        yield text.encode(), spans[cuts[i] : cuts[i + 1]]


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def _report(length: int) -> Callable:
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(sum(b - a for a, b in spans), len(spans), hashlib.sha256(_kept(data, spans)).hexdigest()) for data, spans in _covered(batch, length)]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *columns], names=["node", "n_removed", "n_spans", "kept_sha256"])

    return report


def _trim(length: int, least_words: int) -> Callable:
    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [_kept(data, [(a, b) for a, b in spans if len(data[a:b].split()) >= least_words]).decode("utf-8", "ignore") for data, spans in _covered(batch, length)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(kept, pa.string())], names=["node", "kept"])

    return trim


def _by_text(docs: DataFrame, cut: DataFrame, text: str, key: str, length: int, what: Callable, schema: str) -> DataFrame:
    """One row per text with repeats, from what(batches of node, text, hits)."""
    found = repeats(docs, cut, text, key, length)
    return _texts_of(docs, found, text, key, length).select("node", "text", "hits").mapInArrow(what, schema).dropDuplicates(["node"])


def dedup_report(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256, shares_passage), one for every row of docs.

    Texts are UTF-8 bytes; null counts as empty. Every byte covered by `length` bytes that start anywhere else too,
    in this text or another row, is removed; matches never cross rows. Repeated rows are copies of each other,
    so all their bytes go once they have `length`. shares_passage is 1 if a marked window of MARK bytes stands in
    another row too, else 0: a passage of MARK + MARK_STEP - 1 bytes that rows share has one at least, so it tells
    of shared passages that are too short to be removed. Very long texts are cut in segments, ties cannot arise;
    null keys, extra columns of any name and empty tables are fine.
    """
    spark = docs.sparkSession
    with scratch(spark):
        cut = materialize(cut_texts(docs, text, key, length, True))
        removed = _by_text(docs, cut, text, key, length, _report(length), "node binary, n_removed bigint, n_spans bigint, kept_sha256 string")
        found = lasting(materialize(removed).join(marked_passages(cut), "node", "full"))
    t: Column = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.unhex(F.md5(F.col(text))).alias("node"), F.octet_length(t).cast("long").alias("n_bytes"), F.sha2(t, 256).alias("whole"))
    rows = rows.join(found, "node", "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select("doc_id", "n_bytes", number("n_removed"), number("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"), number("shares_passage"))


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, least_words: int = 0) -> DataFrame:
    """docs, with all rows and columns, their texts without repeated bytes (and without what a cut leaves of a
    character). Of what `length` repeated bytes cover, runs of fewer than least_words words stay."""
    spark = docs.sparkSession
    with scratch(spark):
        cut = materialize(cut_texts(docs, text, key, length, False))
        found = lasting(_by_text(docs, cut, text, key, length, _trim(length, least_words), "node binary, kept string"))
    row, node = free_name(docs, "row"), free_name(docs, "node")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias(row)).withColumn(node, F.unhex(F.md5(F.col(row)[text])))
    found = found.select(F.col("node").alias("found_node"), F.col("kept").alias("found_kept"))
    joined = rows.join(found, F.col(node) == F.col("found_node"), "left")
    return joined.select(*[(F.coalesce(F.col("found_kept"), F.col(row)[c]) if c == text else F.col(row)[c]).alias(c) for c in docs.columns])
