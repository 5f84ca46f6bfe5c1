"""Approximate nearest neighbours over learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts that keep neighbours together. A small
classifier learns the parts from the vectors; it places every vector of the table and names the most probable
parts of every query. Parts of large tables are cut again in the same way, each from a bounded sample of its own, so
that the number of parts grows with the table. Within the parts a query visits all candidates are ranked by exact
cosine, cell by cell: a cell holds several small parts, or a block of a large one, and each query that visits it once.

Vectors travel as bytes of doubles. Single-precision products only tell which candidates cannot be among the nearest.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import lasting, materialize, scratch

#: Sampled vectors per part, least and most parts of one cut, and vectors of the table per part within that range; a
#: part of the first cut with over twice as many is cut again.
SAMPLE_PER_PART, LEAST_PARTS, MOST_PARTS, ROWS_PER_PART = 48, 2, 128, 800
#: Neighbours in the graph; most a part may hold, as a multiple of its even share.
DEGREE, BALANCE = 10, 1.1
#: A query visits so many of its most probable parts that, for sampled vectors kept out of training, this share of
#: their nearest sampled neighbours lies in the visited parts; every KEPT_OUTth sampled vector is kept out.
RECALL, KEPT_OUT = 0.95, 8
#: Candidates and queries that meet in one task at a time: candidates are at least BLOCK, up to CELL or CELL_BYTES of
#: vectors if the table has CELLS times as many.
BLOCK, TURN = 2000, 8000
CELL, CELL_BYTES, CELLS = 16_384, 16 << 20, 32
#: Products of one multiplication, pairs whose exact cosine is computed at once.
PRODUCTS, PAIRS = 1 << 19, 1 << 15
#: Rows and bytes of vectors that Python functions take at a time; vectors a task remembers to have passed on.
CHUNK, CHUNK_BYTES, SEEN = 32_768, 32 << 20, 200_000
#: Values of the hash that draws samples; the primes of xxHash and its value of the word that the second hash begins with.
HASHES = 1 << 53
PRIMES = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
AGAIN = np.uint64(0xA7B9233E9D4EBA12)
RESULT = "query_id long, rank int, vec_id long, score double"


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """Indices of each unit vector's nearest others."""
    out = []
    degree = min(degree, len(x) - 1)
    for i in range(0, len(x), 512):
        s = x[i : i + 512] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out.append(np.argpartition(-s, degree - 1, axis=1)[:, :degree] if degree else np.zeros((len(s), 0), int))
    return np.concatenate(out)


def balanced_parts(x: np.ndarray, parts: int, seed: int = 7, rounds: int = 12) -> np.ndarray:
    """Cut the neighbour graph into parts of about even size.

    Parts grow breadth-first from spread-out seeds up to their capacity; then vertices move, best gain first, to
    the part that holds most of their neighbours as long as it has room.
    """
    rng = np.random.default_rng(seed)
    n = len(x)
    room = int(np.ceil(BALANCE * n / parts))
    graph = neighbour_graph(x, DEGREE)
    near: list[list[int]] = [list(r) for r in graph]
    for i, r in enumerate(graph.tolist()):
        for j in r:
            near[j].append(i)
    ends, others = np.repeat(np.arange(n), [len(us) for us in near]), np.concatenate([np.asarray(us, int) for us in near])
    seeds = [int(rng.integers(n))]
    far = x @ x[seeds[0]]
    while len(seeds) < parts:
        seeds.append(int(far.argmin()))
        far = np.maximum(far, x @ x[seeds[-1]])
        far[seeds] = np.inf
    part = np.full(n, -1)
    sizes = np.zeros(parts, int)
    fronts = [[s] for s in seeds]
    while any(fronts):
        for p in np.argsort(sizes, kind="stable").tolist():
            while fronts[p]:
                v = fronts[p].pop(0)
                if part[v] < 0 and sizes[p] < room:
                    part[v] = p
                    sizes[p] += 1
                    fronts[p].extend(u for u in near[v] if part[u] < 0)
                    break
    for v in np.flatnonzero(part < 0).tolist():
        p = int(np.where(sizes < room, x[seeds] @ x[v], -np.inf).argmax())
        part[v] = p
        sizes[p] += 1
    for _ in range(rounds):
        votes = np.bincount(ends * parts + part[others], minlength=n * parts).reshape(n, parts)
        gain = votes.max(1) - votes[np.arange(n), part]
        moved = 0
        for v in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())].tolist():
            p = int(np.where(sizes < room, votes[v], -1).argmax())
            if votes[v, p] > votes[v, part[v]]:
                sizes[part[v]] -= 1
                sizes[p] += 1
                part[v] = p
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """One hidden layer over unit vectors; gives log probabilities of the parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(unit(x) @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def train_router(x: np.ndarray, part: np.ndarray, parts: int, hidden: int = 128, epochs: int = 60, seed: int = 7) -> Router:
    """Adam on cross entropy; x are unit vectors."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    p = [rng.normal(0, np.sqrt(2 / d), (d, hidden)) * 4, np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 128):
            b = order[i : i + 128]
            h = np.maximum(x[b] @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            z = np.exp(z - z.max(1, keepdims=True))
            z /= z.sum(1, keepdims=True)
            z[np.arange(len(b)), part[b]] -= 1
            z /= len(b)
            dh = (z @ p[2].T) * (h > 0)
            t += 1
            for j, g in enumerate((x[b].T @ dh, dh.sum(0), h.T @ z, z.sum(0))):
                m[j] += 0.1 * (g - m[j])
                g *= g
                g -= v[j]
                g *= 0.001
                v[j] += g
                np.sqrt(np.divide(v[j], 1 - 0.999**t, out=g), out=g)
                g += 1e-8
                step = m[j] / (1 - 0.9**t)
                step *= 0.003
                step /= g
                p[j] -= step
    return Router(*p)


def matrix(column: pd.Series) -> np.ndarray:
    """Vectors of one length, given as bytes."""
    return np.frombuffer(b"".join(column)).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def vectors_in(column: pa.ChunkedArray) -> np.ndarray:
    """The same of an Arrow column without nulls."""
    if not len(column):
        return np.zeros((0, 1))
    column = column.cast(pa.large_binary()).combine_chunks()
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.float64).reshape(len(column), -1)


def packed(x: np.ndarray) -> pa.Array:
    """Rows of a matrix as bytes."""
    x = np.ascontiguousarray(x)
    ends = np.arange(len(x) + 1, dtype=np.int64) * (8 * x.shape[1])
    return pa.Array.from_buffers(pa.large_binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(x)])


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Consecutive values as lists of so many."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values, kind))


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists without nulls, and their numbers by row."""
    counts = [c.value_lengths().to_numpy(zero_copy_only=False) for c in column.chunks]
    values = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return (np.concatenate(values), np.concatenate(counts)) if values else (np.zeros(0, int), np.zeros(0, int))


def in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to tables that are worth a call and bounded in bytes."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows:
            held.append(b)
        if sum(x.num_rows for x in held) >= CHUNK or sum(x.nbytes for x in held) >= CHUNK_BYTES:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def ranks(new: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """How many counted rows stand before each row in its group; new marks the first rows of groups."""
    before = np.cumsum(counted) - counted
    return before - before[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]


def changes(*columns: np.ndarray) -> np.ndarray:
    """Rows that differ from the row before in any of the columns."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return out


def spread(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of vectors of doubles: Spark's xxhash64(v) and xxhash64('again', v), a column at a time."""
    one, two = np.full(len(x), 42, np.uint64), np.full(len(x), AGAIN, np.uint64)
    for bits in np.ascontiguousarray((x + 0.0).T).view(np.uint64):  # -0.0 counts as 0.0
        bits = bits * PRIMES[1]
        bits = ((bits << np.uint64(31)) | (bits >> np.uint64(33))) * PRIMES[0]
        for h in (one, two):
            h += PRIMES[4] + np.uint64(8)
            h ^= bits
            high = h >> np.uint64(37)
            h <<= np.uint64(27)
            h |= high
            h *= PRIMES[0]
            h += PRIMES[3]
            h ^= h >> np.uint64(33)
            h *= PRIMES[1]
            h ^= h >> np.uint64(29)
            h *= PRIMES[2]
            h ^= h >> np.uint64(32)
    return one.view(np.int64), two.view(np.int64)


def gather(every: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, v) to (id, one, two, n, many, vec), for vectors that take part.

    Of the copies in a chunk stay those with the k + 1 smallest ids and all queries. A vector that the task has passed
    on lately is null. many: of the rows read, those of this length n (in the first row of each length and chunk).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for t in in_chunks(batches):
            values, sizes = flat(t["v"])
            values, starts = values.astype(np.float64, copy=False), np.cumsum(sizes) - sizes
            ids = t["id"].to_numpy()
            for n in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == n)
                x = values.reshape(-1, n) if len(at) == len(sizes) else values[starts[at][:, None] + np.arange(n)]
                good = np.isfinite(x).all(1) & (x != 0).any(1)  # nulls came as NaN
                x, at = x[good], at[good]
                if not len(at):
                    continue
                one, two = spread(x)
                order = np.lexsort((ids[at], two, one))
                a, b, i = one[order], two[order], ids[at][order]
                new = changes(a, b)
                other = changes(a, b, i)
                keep = np.flatnonzero(other & ((ranks(new, other) <= k) | (i % every == 0)))
                source = np.full(len(keep), -1)
                for row, pair in zip(np.flatnonzero(new[keep]).tolist(), zip(a[keep][new[keep]].tolist(), b[keep][new[keep]].tolist())):
                    if pair not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(pair)
                        source[row] = order[keep[row]]
                many = np.zeros(len(keep), np.int64)
                many[0] = len(at)
                vec = packed(x[source[source >= 0]]).cast(pa.binary()).take(pa.array(np.cumsum(source >= 0) - 1, mask=source < 0))
                yield pa.RecordBatch.from_arrays([pa.array(i[keep]), pa.array(a[keep]), pa.array(b[keep]), pa.array(np.full(len(keep), n, np.int32)), pa.array(many), vec], ["id", "one", "two", "n", "many", "vec"])

    return run


def collapse(every: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, one, two, vec) in order of one, two, id to (one, two, vec, ids, asked), one per different vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for t in in_chunks(batches):
            t = pa.concat_tables([rest, t]).combine_chunks() if rest is not None else t.combine_chunks()
            one, two, ids = (t[c].to_numpy() for c in ("one", "two", "id"))
            new, other = changes(one, two), changes(one, two, ids)
            last = int(np.flatnonzero(new)[-1])
            # of the last vector, which may go on, stay its smallest ids, one query and one row with the vector
            asked, whole = ids % every == 0, t["vec"].is_valid().to_numpy()
            low = other & (ranks(new, other) <= k)
            stays = low | (asked & (ranks(new, asked) == 0)) | (whole & (ranks(new, whole) == 0))
            rest = t.take(np.flatnonzero(stays[last:]) + last)
            if last:
                yield _collapsed(t.slice(0, last), new[:last], low[:last], asked[:last], whole[:last])
        if rest is not None:
            one, two, ids = (rest[c].to_numpy() for c in ("one", "two", "id"))
            new, other = changes(one, two), changes(one, two, ids)
            yield _collapsed(rest, new, other & (ranks(new, other) <= k), ids % every == 0, rest["vec"].is_valid().to_numpy())

    return run


def _collapsed(t: pa.Table, new: np.ndarray, low: np.ndarray, asked: np.ndarray, whole: np.ndarray) -> pa.RecordBatch:
    group, first = np.cumsum(new) - 1, np.flatnonzero(new)
    vec = np.flatnonzero(whole & (ranks(new, whole) == 0))
    columns = [t["one"].take(first), t["two"].take(first), t["vec"].take(vec), lists(t["id"].to_numpy()[low], np.bincount(group[low], minlength=len(first)), pa.int64()), pa.array(np.bincount(group[asked], minlength=len(first)) > 0)]
    return pa.Table.from_arrays(columns, ["one", "two", "vec", "ids", "asked"]).combine_chunks().to_batches()[0]


@dataclass
class Tree:
    """Routers of the first cut and of parts cut again (None: not cut); leaves are numbered part by part."""

    top: Router
    below: list[Router | None]

    def sizes(self) -> list[int]:
        return [len(r.b2) if r else 1 for r in self.below]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of every leaf, for a few vectors."""
        top = self.top.probabilities(x)
        return np.hstack([top[:, i : i + 1] * r.probabilities(x) if r else top[:, i : i + 1] for i, r in enumerate(self.below)])

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The most probable leaf of the most probable part."""
        part = self.top.probabilities(x).argmax(1)
        out = np.concatenate([[0], np.cumsum(self.sizes())])[part]
        for i in np.unique(part).tolist():
            if self.below[i]:
                out[part == i] += self.below[i].probabilities(x[part == i]).argmax(1)
        return out

    def visits(self, x: np.ndarray, most: int) -> list[list[int]]:
        """The most probable leaves of each vector."""
        out: list[list[int]] = []
        for i in range(0, len(x), 128):
            out += np.argsort(-self.probabilities(x[i : i + 128]), axis=1, kind="stable")[:, :most].tolist()
        return out


def visits_needed(tree: Tree, x: np.ndarray, tests: np.ndarray, k: int) -> int:
    """Leaves to visit for RECALL, measured on unit vectors the routers were not trained on."""
    if not len(tests):
        return sum(tree.sizes())
    leaf, needed = tree.leaf(x), []
    for i in range(0, len(tests), 128):
        part = tests[i : i + 128]
        order = np.argsort(np.argsort(-tree.probabilities(part), axis=1, kind="stable"), axis=1)
        needed.append(np.take_along_axis(order, leaf[np.argsort(-(part @ x.T), axis=1)[:, :k]], 1).ravel())
    found = np.sort(np.concatenate(needed))
    return int(found[min(len(found) - 1, int(np.ceil(RECALL * len(found))))]) + 1


def fit_router(x: np.ndarray, parts: int) -> Router:
    """A router over about so many parts of these unit vectors, fewer if they are few."""
    parts = max(1, min(parts, len(x) // 4))
    return train_router(x, balanced_parts(x, parts), parts)


def best_in_cell(candidates: np.ndarray, firsts: np.ndarray, parts: np.ndarray, queries: np.ndarray, asking: np.ndarray, asked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the k nearest candidates of each query and their cosines, ties to the smaller first id.

    Query asking[i] visits part asked[i]. Where there are fewer, rows are -1. A product of unit vectors in single
    precision is off by less than slack; whatever may be among the k nearest so far gets its exact cosine.
    """
    order, visits = np.argsort(parts, kind="stable"), np.argsort(asked, kind="stable")
    candidates, firsts, parts, asking, asked = candidates[order], firsts[order], parts[order], asking[visits], asked[visits]
    lengths, norms = np.sqrt((candidates * candidates).sum(1)), np.sqrt((queries * queries).sum(1))
    small, asks = (candidates / lengths[:, None]).astype(np.float32), (queries / norms[:, None]).astype(np.float32)
    slack = 1.2e-7 * (candidates.shape[1] + 8)
    best, score = np.full((len(queries), k), -1), np.full((len(queries), k), -np.inf)
    for p in np.unique(asked).tolist():
        low, high = np.searchsorted(parts, [p, p + 1]).tolist()
        if low == high:
            continue
        block = small[low:high].T
        going = asking[slice(*np.searchsorted(asked, [p, p + 1]).tolist())]
        step = max(1, PRODUCTS // (high - low))
        for at in range(0, len(going), step):
            rows = going[at : at + step]
            rough = asks[rows] @ block
            least = score[rows, -1] - slack
            fresh = np.flatnonzero(np.isinf(least))
            if len(fresh) and high - low > k:
                least[fresh] = np.partition(rough[fresh], high - low - k, axis=1)[:, high - low - k] - 2 * slack
            q, c = np.divmod(np.flatnonzero(rough >= least.astype(np.float32)[:, None]), high - low)
            if not len(q):
                continue
            q, c = rows[q], c + low
            exact = np.concatenate([(candidates[c[i : i + PAIRS]] * queries[q[i : i + PAIRS]]).sum(1) / (lengths[c[i : i + PAIRS]] * norms[q[i : i + PAIRS]]) for i in range(0, len(q), PAIRS)])
            hit = np.unique(q)
            old = best[hit] >= 0
            q = np.concatenate([np.repeat(hit, old.sum(1)), q])
            c, exact = np.concatenate([best[hit][old], c]), np.concatenate([score[hit][old], exact])
            order_now = np.lexsort((firsts[c], -exact, q))
            q, c, exact = q[order_now], c[order_now], exact[order_now]
            nth = ranks(changes(q), np.ones(len(q), int))
            stays = nth < k
            best[q[stays], nth[stays]], score[q[stays], nth[stays]] = c[stays], exact[stays]
    return np.where(best >= 0, order[best], -1), score


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest found of each row whose key is divisible by `every`.

    Vectors null, empty, zero or with null or non-finite components take no part, nor do null keys and vectors
    of another length than the commonest. Rows equal in key and vector count once; copies of one vector are
    collapsed for the search, which keeps their k + 1 smallest keys, and every query still gets its own answer.
    Fewer than k candidates give fewer rows, an empty table none. The index is fitted on bounded samples of
    distinct vectors, by hash; every vector is placed and searched. Other columns of any name are ignored.
    """
    with scratch(vectors.sparkSession):
        return lasting(_nearest(vectors, key, vector, every, k))


def _tree(distinct: DataFrame, total: int, k: int) -> tuple[Tree, int]:
    """The routers, fitted on bounded samples, and how many leaves a query visits.

    What reaches the driver is a sample of MOST_PARTS x SAMPLE_PER_PART vectors and at most MOST_PARTS routers.
    """

    def sampled(rows: DataFrame, wanted: int, of: int) -> DataFrame:
        return rows if of <= wanted else rows.where(F.pmod("one", F.lit(HASHES)) < int(HASHES * wanted / of))

    parts = int(np.clip(total // ROWS_PER_PART, LEAST_PARTS, MOST_PARTS))
    wanted = parts * SAMPLE_PER_PART
    x = unit(matrix(sampled(distinct, wanted, total).select("one", "vec").toPandas().sort_values("one")["vec"]))
    out = np.arange(len(x)) % KEPT_OUT == KEPT_OUT - 1
    top = fit_router(x[~out], parts)
    tree = Tree(top, [None] * len(top.b2))
    if total > 2 * ROWS_PER_PART * len(top.b2):
        drawn = F.pmod("one", F.lit(HASHES)) <= HASHES * SAMPLE_PER_PART / ROWS_PER_PART  # no part's share is larger

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in in_chunks(batches):
                part = top.probabilities(vectors_in(t["vec"])).argmax(1).astype(np.int32)
                vec = pc.if_else(t["drawn"], t["vec"], None)
                yield from pa.Table.from_arrays([t["one"], vec, pa.array(part)], ["one", "vec", "part"]).to_batches()

        def cut(rows: pd.DataFrame) -> pd.DataFrame:
            again = rows["parts"].iloc[0]
            router = fit_router(unit(matrix(rows.sort_values("one")["vec"])), int(again))
            return pd.DataFrame({"part": [rows["part"].iloc[0]], "router": [pickle.dumps(router)]})

        placed = materialize(distinct.select("one", "vec", drawn.alias("drawn")).mapInArrow(place, "one long, vec binary, part int"))
        again = F.least(F.floor(F.col("n") / ROWS_PER_PART), F.lit(MOST_PARTS)).cast("int")
        sizes = materialize(placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * ROWS_PER_PART).withColumn("parts", again))
        some = placed.where("vec is not null").join(sizes, "part").where(F.pmod("one", F.lit(HASHES)) < F.col("parts") * SAMPLE_PER_PART / F.col("n") * HASHES)
        for r in some.select("part", "parts", "one", "vec").groupBy("part").applyInPandas(cut, "part int, router binary").collect():
            tree.below[r["part"]] = pickle.loads(r["router"])
    return tree, visits_needed(tree, x[~out], x[out], k)


@dataclass
class Cells:
    """Where the rows of every leaf are searched: cells first to first + blocks - 1; turns are those of every cell."""

    first: np.ndarray
    blocks: np.ndarray
    turns: np.ndarray

    @classmethod
    def plan(cls, sizes: np.ndarray, visits: np.ndarray, queries: int, room: int) -> Cells:
        """Leaves of over `room` rows are cut into blocks, smaller ones share cells; visits are those of every leaf."""
        first, blocks, cell, held = np.zeros(len(sizes), int), np.maximum(1, -(-sizes // room)), 0, 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > room:
                cell, held = cell + 1, 0
            first[i] = cell
            cell, held = (cell + int(blocks[i]), 0) if blocks[i] > 1 else (cell, held + n)
        asked = np.zeros(cell + 1, int)
        for i, b in enumerate(blocks.tolist()):
            asked[first[i] : first[i] + b] += visits[i]
        return cls(first, blocks, -(-np.minimum(asked, queries) // TURN))

    def deal(self, t: pa.Table) -> Iterator[pa.Table]:
        """Rows (cell, turn, asks, one, two, vec, part, ids, parts) of placed vectors: candidates, then queries.

        However many turns and cells there are, no table has more than CHUNK rows or as many as t.
        """
        two, part = t["two"].to_numpy() & ((1 << 30) - 1), t["part"].to_numpy()
        cell = self.first[part] + two % self.blocks[part]
        for turn in range(int(self.turns.max())):
            row = np.flatnonzero(self.turns[cell] > turn)
            yield self._rows(t, row, cell[row], np.full(len(row), turn), False, t["part"].take(row), t["ids"].take(row), pa.nulls(len(row), pa.list_(pa.int32())))
        rows = np.flatnonzero(t["asked"].to_numpy())
        if not len(rows):
            return
        leaves, counts = flat(t["visits"].take(rows))
        row = np.repeat(rows, counts)
        times = self.blocks[leaves]
        row, leaves = np.repeat(row, times), np.repeat(leaves, times)
        start = np.repeat(np.cumsum(times) - times, times)
        cell = self.first[leaves] + np.arange(len(leaves)) - start
        order = np.lexsort((cell, row))
        row, cell, leaves = row[order], cell[order], leaves[order]
        at = np.flatnonzero(changes(row, cell))
        parts = lists(leaves, np.diff(np.append(at, len(row))), pa.int32())
        for i in range(0, len(at), CHUNK):
            r, c = row[at[i : i + CHUNK]], cell[at[i : i + CHUNK]]
            yield self._rows(t, r, c, two[r] % np.maximum(1, self.turns[c]), True, pa.nulls(len(r), pa.int32()), pa.nulls(len(r), pa.list_(pa.int64())), parts.slice(i, CHUNK))

    @staticmethod
    def _rows(t: pa.Table, row: np.ndarray, cell: np.ndarray, turn: np.ndarray, asks: bool, *more: pa.Array) -> pa.Table:
        columns = [pa.array(cell, pa.int32()), pa.array(turn, pa.int32()), pa.array(np.full(len(row), asks)), *(t[c].take(row) for c in ("one", "two", "vec")), *more]
        return pa.Table.from_arrays(columns, ["cell", "turn", "asks", "one", "two", "vec", "part", "ids", "parts"])


FOUND = pa.schema([("q1", pa.int64()), ("q2", pa.int64()), ("first", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])


def search(t: pa.Table, k: int) -> pa.Table:
    """The k nearest candidates of each query in one turn of a cell."""
    asks = t["asks"].to_numpy()
    c, q = t.take(np.flatnonzero(~asks)), t.take(np.flatnonzero(asks))
    if not c.num_rows or not q.num_rows:
        return FOUND.empty_table()
    asked, counts = flat(q["parts"])
    ids, sizes = flat(c["ids"])
    firsts = ids[np.cumsum(sizes) - sizes]
    best, score = best_in_cell(vectors_in(c["vec"]), firsts, c["part"].to_numpy(), vectors_in(q["vec"]), np.repeat(np.arange(q.num_rows), counts), asked, k)
    row, nth = np.nonzero(best >= 0)
    found = best[row, nth]
    return pa.Table.from_arrays([q["one"].take(row), q["two"].take(row), pa.array(firsts[found]), pa.array(score[row, nth]), c["ids"].take(found)], schema=FOUND)


def _nearest(vectors: DataFrame, key: str, vector: str, every: int, k: int) -> DataFrame:
    spark = vectors.sparkSession
    v = F.col(vector)
    if vectors.select(v).schema[0].dataType.simpleString() != "array<float>":  # floats become doubles in Python, which is quicker
        v = v.cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null and size(v) > 0")
    rows = materialize(rows.mapInArrow(gather(every, k), "id long, one long, two long, n int, many long, vec binary"))
    shape = rows.groupBy("n").agg(F.sum("many").alias("count")).orderBy(F.desc("count"), "n").first()
    if shape is None:
        return spark.createDataFrame([], RESULT)
    rows = rows.where(F.col("n") == shape["n"])
    apart = rows.select("id", "one", "two", "vec").repartition("one", "two").sortWithinPartitions("one", "two", "id")
    distinct = materialize(apart.mapInArrow(collapse(every, k), "one long, two long, vec binary, ids array<long>, asked boolean"))
    total = distinct.count()
    tree, visited = _tree(distinct, total, k)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in in_chunks(batches):
            x, asked = vectors_in(t["vec"]), t["asked"].to_numpy()
            goes = iter(tree.visits(x[asked], visited))
            visits = pa.array([next(goes) if a else None for a in asked], pa.list_(pa.int32()))
            yield from t.append_column("part", pa.array(tree.leaf(x), pa.int32())).append_column("visits", visits).to_batches()

    placed = materialize(distinct.mapInArrow(place, "one long, two long, vec binary, ids array<long>, asked boolean, part int, visits array<int>"))
    leaves = sum(tree.sizes())
    sizes, visits = np.zeros(leaves, int), np.zeros(leaves, int)
    for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["part"]] = r["n"]
    queries = placed.where("asked").count()
    for r in placed.where("asked").select(F.explode("visits").alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect():
        visits[r["part"]] = r["n"]
    room = int(np.clip(min(CELL, total // CELLS, CELL_BYTES // (8 * shape["n"])), BLOCK, CELL))
    cells = Cells.plan(sizes, visits, queries, room)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in in_chunks(batches):
            for out in cells.deal(t.combine_chunks()):
                yield from out.to_batches(CHUNK)

    def meet(t: pa.Table) -> pa.Table:
        return search(t, k + 1)

    dealt = placed.mapInArrow(deal, "cell int, turn int, asks boolean, one long, two long, vec binary, part int, ids array<long>, parts array<int>")
    found = dealt.groupBy("cell", "turn").applyInArrow(meet, "q1 long, q2 long, first long, score double, ids array<long>")
    top = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "first")
    found = found.withColumn("nth", F.row_number().over(top)).where(F.col("nth") <= k + 1)
    pairs = found.groupBy(F.col("q1").alias("one"), F.col("q2").alias("two")).agg(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("far"), i.alias("id"))))).alias("near"))
    queries = rows.where(F.pmod("id", F.lit(every)) == 0).select("id", "one", "two").distinct()
    answers = queries.join(materialize(pairs), ["one", "two"])
    best = F.slice(F.array_sort(F.filter("near", lambda x: x["id"] != F.col("id"))), 1, k)
    answers = answers.select(F.col("id").alias("query_id"), F.posexplode(best).alias("at", "x"))
    return answers.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.far")).alias("score"))
