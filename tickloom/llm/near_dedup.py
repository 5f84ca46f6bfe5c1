"""MinHash near-duplicates by DartMinHash.

Each element of a weighted set owns one fixed random scatter of darts over the plane (weight, rank), one dart
per unit of area. A set throws the darts of its elements that lie below the elements' weights and below a rank
that gives about k (ln k + 2) darts for the whole set, whatever its size; a dart also names one of the k
coordinates. The smallest rank of a coordinate is its signature value, and two sets agree in a coordinate with
the probability of their weighted Jaccard similarity. Sets that leave a coordinate empty throw again with twice
the rank. The signature is cut into bands; texts that share a band are compared with leaders of that band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, lasting, materialize, scratch
from tickloom.llm.components import components
from tickloom.llm.shingles import Shingler, jaccard, mix, pack, unpack

BANDS, ROWS = 28, 6
THRESHOLD = 0.8
GOLD = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64(0xFFFFFF)
#: Rank cells double in length from a quarter up to WIDEST and keep that length from there on.
FIRST, WIDEST = 0.25, 256.0


def _cell(nth: int) -> tuple[float, float]:
    """Start and length of a rank cell."""
    doubling = int(np.log2(WIDEST / FIRST)) + 1
    if nth == 0:
        return 0.0, FIRST
    if nth < doubling:
        return FIRST * 2.0 ** (nth - 1), FIRST * 2.0 ** (nth - 1)
    return WIDEST * (nth - doubling + 1), WIDEST


def _steps(area: float) -> np.ndarray:
    """Distribution function of the number of darts in a cell of this area."""
    most = int(area + 12 * np.sqrt(area) + 16)
    return np.cumsum(np.exp(np.cumsum(np.r_[-area, np.log(area / np.arange(1, most))])))


STEPS = {length: _steps(length) for length in {_cell(i)[1] for i in range(12)}}


def _throw(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, rank_limit: np.ndarray, k: int, out: np.ndarray) -> None:
    """Lower out[set, coordinate] to the ranks of the darts of these elements; rank_limit is per set."""
    flat = out.reshape(-1)
    column = 0
    while len(elements):
        limit, nth = rank_limit[owner], 0
        live = elements, weights, owner, limit
        while True:
            start, length = _cell(nth)
            use = live[3] > start
            if not use.all():
                live = tuple(x[use] for x in live)
            e, w, o, most = live
            if not len(e):
                break
            with np.errstate(over="ignore"):
                seed = mix(e + GOLD * np.uint64(nth * 4096 + column + 1))
                darts = np.searchsorted(STEPS[length], (seed >> np.uint64(11)).astype(np.float64) * 2.0**-53)
                who = np.repeat(np.arange(len(e)), darts)
                m = np.arange(len(who)) - np.repeat(np.cumsum(darts) - darts, darts)
                h = mix(seed[who] ^ (GOLD * (m + 2).astype(np.uint64)))
            rank = start + length * ((h >> np.uint64(24)).astype(np.float64) * 2.0**-40)
            inside = rank <= most[who]
            if (w < column + 1).any():
                with np.errstate(over="ignore"):
                    inside &= column + (mix(h) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < w[who]
            who, rank, h = who[inside], rank[inside], h[inside]
            coordinate = (((h & LOW) * np.uint64(k)) >> np.uint64(24)).astype(np.int64)
            np.minimum.at(flat, o[who] * k + coordinate, rank)
            nth += 1
        column += 1
        use = weights > column
        elements, weights, owner = elements[use], weights[use], owner[use]


def signatures(elements: np.ndarray, weights: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """One row of k ranks per set; the sets' elements lie one after another. An empty set has only infinities."""
    out = np.full((len(sizes), k), np.inf)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    total = np.bincount(owner, weights, len(sizes))
    todo = total > 0
    limit = np.where(todo, k * (np.log(k) + 2) / np.where(todo, total, 1), 0)
    while todo.any():
        use = todo[owner]
        _throw(elements[use], weights[use], owner[use], limit, k, out)
        todo &= np.isinf(out).any(axis=1)
        limit = limit * 2
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), bands, rows)
    with np.errstate(over="ignore"):
        h = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * GOLD), bits.shape[:2]).copy()
        for r in range(rows):
            h = mix(h * GOLD + bits[:, :, r])
    return h.view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        for at in range(0, batch.num_rows, 250):
            part = batch.slice(at, 250)
            sets = shingler.sets(part.column("text").to_pylist())
            sizes = np.array([len(s) for s in sets])
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
            keys = band_keys(signatures(flat, np.ones(len(flat)), sizes, BANDS * ROWS), BANDS, ROWS)
            keys = keys[sizes > 0]
            offsets = np.r_[0, np.cumsum(np.where(sizes > 0, BANDS, 0))].astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("node"), bands], names=["doc_id", "node", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        for at in range(0, batch.num_rows, 250):
            part = batch.slice(at, 250)
            packed = [pack(s) for s in shingler.sets(part.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(packed, pa.binary())], names=["node", "shingles"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = (batch.column(c).to_pylist() for c in ("left", "right"))
        linked = [jaccard(unpack(x), unpack(y)) >= THRESHOLD for x, y in zip(left, right)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with the column linked: whether their shingle sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(_compare, "a binary, b binary, linked boolean")


def _links(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): linked pairs that connect all texts that bands bring together.

    In each band all members are compared with two of them: the smallest, and the largest by an order that differs
    among bands. Members outside the component that most members of a band are in then meet all members of their
    bands in an exact join on rare shingles, so of two members that are not connected yet at least one does: no
    band is capped, and a band of alike texts costs two comparisons a member.
    """
    other = F.max_by("node", F.xxhash64("node", F.pmod("band", F.lit(3))))
    heads = buckets.groupBy("band").agg(F.min("node").alias("lo"), F.when(F.pmod("band", F.lit(3)) == 0, F.max("node")).otherwise(other).alias("hi"))
    leaders = materialize(heads.select("band", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("lead")))
    met = buckets.join(leaders, "band").where("node <> lead").select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
    tested = materialize(_checked(met, sets))
    links = tested.where("linked").select("a", "b")
    labels = components(links)
    own = labels.toDF("node", "label")
    labelled = buckets.join(own, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    most = materialize(labelled.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("band").agg(F.max_by("label", F.struct("n", "label")).alias("label")))
    rest = materialize(labelled.join(most, ["band", "label"], "left_anti").select("band", "node"))
    near = buckets.join(rest.select("band").distinct(), "band", "left_semi").select("node").distinct()
    near = near.join(rest.select("node").distinct().withColumn("probe", F.lit(True)), "node", "left").na.fill(False, ["probe"])
    near = materialize(near.join(own, "node", "left").select("node", "probe", F.coalesce("label", "node").alias("label")))
    pairs = _rare_pairs(sets.join(near, "node")).join(tested.select("a", "b"), ["a", "b"], "left_anti")
    return links.union(materialize(_checked(pairs, sets)).where("linked").select("a", "b"))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [unpack(x) for x in batch.column("shingles").to_pylist()]
        offsets = np.r_[0, np.cumsum([len(v) for v in values])].astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*values, np.zeros(0, np.uint64)]).view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("probe"), batch.column("label"), lists], names=["node", "probe", "label", "shingles"])


def _rare_pairs(sets: DataFrame) -> DataFrame:
    """(a, b): every pair with a probe, not connected so far, that can reach the threshold by prefix and position.

    With shingles in one order, rarest first, two sets that similar share one among the first n - ceil(t n) + 1 of
    each; and the first they share leaves room for enough others behind it. Texts whose rare shingles are their own
    meet nobody.
    """
    rows = sets.select("node", "probe", "label", "shingles").mapInArrow(_unpacked, "node binary, probe boolean, label binary, shingles array<bigint>")
    each = materialize(rows.select("node", "probe", "label", F.explode("shingles").alias("shingle")))
    often = materialize(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")))
    ordered = each.join(often, "shingle").groupBy("node", "probe", "label").agg(F.array_sort(F.collect_list(F.struct("times", "shingle"))).alias("s"))
    n = F.size("s")
    first = ordered.select("node", "probe", "label", n.alias("n"), F.posexplode(F.slice("s", F.lit(1), (n - F.ceil(n * THRESHOLD - 1e-9) + 1).cast("int"))).alias("at", "x"))
    first = materialize(first.where("x.times > 1").select("node", "probe", "label", "n", "at", F.col("x.shingle").alias("shingle")))
    x, y = first.where("probe").toDF("a", "ap", "al", "an", "aat", "shingle"), first.toDF("b", "bp", "bl", "bn", "bat", "shingle")
    enough = F.ceil((F.col("an") + F.col("bn")) * (THRESHOLD / (1 + THRESHOLD)) - 1e-9)
    fits = F.least(F.col("an") - F.col("aat"), F.col("bn") - F.col("bat")) >= enough
    once = (F.col("a") < F.col("b")) | ((F.col("a") > F.col("b")) & ~F.col("bp"))
    x, y = x.withColumnRenamed("shingle", "as"), y.withColumnRenamed("shingle", "bs")
    return x.join(y, (F.col("as") == F.col("bs")) & (F.col("al") != F.col("bl")) & fits & once).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, node, class_id, rows, kept): one row for every key and text of docs that has words.

    node is a digest of the text, class_id the smallest key of the class, rows how many equal rows there are,
    kept marks the one row of a class to keep (the smallest key, then node; null keys last). What joins read is
    written before, so that a band or class with very many rows can be split when it is joined.
    """
    with scratch(docs.sparkSession):
        return lasting(_classes(docs, text, key))


def _classes(docs: DataFrame, text: str, key: str) -> DataFrame:
    slim = docs.select(F.col(key).alias("doc_id"), F.unhex(F.md5(F.col(text))).alias("node"), F.col(text).alias("text")).where("text is not null")
    sketched = materialize(slim.mapInArrow(_sketch, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, node binary, bands array<bigint>").where("size(bands) > 0"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id"))["doc_id"]
    nodes = materialize(sketched.groupBy("node").agg(first.alias("rep"), F.min("bands").alias("bands")))
    buckets = nodes.select("node", F.explode("bands").alias("band"))
    shared = materialize(buckets.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("band"))
    buckets = materialize(buckets.join(shared, "band"))
    wanted = buckets.select("node").distinct().join(nodes.select("node", "rep"), "node").withColumnRenamed("node", "n")
    texts = slim.join(wanted, (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("node", "text").dropDuplicates(["node"])
    sets = materialize(texts.mapInArrow(_sets, "node binary, shingles binary"))
    labels = components(_links(buckets, sets))
    members = sketched.groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("rows"))
    members = members.join(labels, "node", "left").select("doc_id", "node", "rows", F.coalesce("label", "node").alias("label"))
    members = materialize(members)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("node").alias("n")))
    heads = materialize(members.groupBy("label").agg(best.alias("head")))
    is_head = F.col("doc_id").eqNullSafe(F.col("head.id")) & (F.col("node") == F.col("head.n"))
    return members.join(heads, "label").select("doc_id", "node", F.col("head.id").alias("class_id"), "rows", is_head.alias("kept"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (doc_id, class_id, kept), one for every row of docs.

    class_id is the smallest doc_id of a class of texts connected by similarities of 0.8 or more between their
    sets of five-word shingles; kept is true for that document. Null texts and texts without words are alone in
    their class and kept. Repeated rows share a class and its mark. An empty table gives an empty result; extra
    columns are ignored.
    """
    found = classes(docs, text, key).select(F.col("doc_id").alias("d"), F.col("node").alias("n"), "class_id", "kept")
    rows = docs.select(F.col(key).alias("doc_id"), F.unhex(F.md5(F.col(text))).alias("node"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("node") == F.col("n")), "left")
    return joined.select("doc_id", F.when(F.col("kept").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("kept", F.lit(True)).alias("kept"))


def one_per_class(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs, with their columns, one row of each class; null and wordless texts all stay."""
    found = classes(docs, text, key)
    row, node, gone = (free_name(docs, c) for c in ("row", "node", "gone"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias(row))
    rows = rows.withColumn(node, F.unhex(F.md5(F.col(row)[text])))
    out = found.where("not kept or rows > 1").select(F.col("doc_id").alias("d"), F.col("node").alias("n"), (~F.col("kept")).alias(gone))
    joined = rows.join(out, F.col(row)[key].eqNullSafe(F.col("d")) & (F.col(node) == F.col("n")), "left")
    single = joined.where(F.col(gone).isNull()).select(f"{row}.*")
    repeated = joined.where(~F.col(gone)).select(f"{row}.*", F.struct("d", "n").alias(gone)).dropDuplicates([gone]).drop(gone)
    return single.union(repeated)
