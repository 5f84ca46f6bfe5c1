"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

A source whose target is r times its size takes floor(r) certain copies of every document. The rest is a
fixed-size Pareto sample: each document has a random number u from a hash of its row, its rank is the odds of
u divided by the odds of its inclusion probability, and the lowest ranks are taken until the source's words
are reached. The cut is found by two rounds of histograms over ranks and an exact pass over the one bin left,
so no task ever sorts a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import free_name, materialize

#: What separates words: space and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)
#: Bins of each round of histograms; a bin of the second round holds about 1/65,536 of a source.
BINS = 256


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*columns: Column) -> Column:
    """A number strictly between 0 and 1 from the row's own values: reruns agree."""
    joined = F.concat(*[x for c in columns for x in (F.coalesce(c.cast("string"), F.lit("")), F.lit("\x1f"))])
    return (F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Targets share `share` times all words by weight; none exceeds `most` times its source, and what is over
    goes to the others by weight until it fits. That end point has one level: a source gets the lesser of its
    bound and level x weight, so it is found by one pass over the sources in the order of bound / weight.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(everything) - 1, F.lit(len(weights))) + 1).cast("int"))
    by_need = Window.orderBy("need", "nth")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.select("source", "source_size", w.alias("w"), F.row_number().over(everything).alias("nth"), (F.lit(most) * F.col("source_size")).alias("bound"))
    rows = rows.withColumn("need", F.col("bound") / F.col("w"))
    over_all = Window.partitionBy(F.lit(1))
    rows = rows.withColumn("level", (F.lit(share) * F.sum("source_size").over(over_all) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / (F.sum("w").over(over_all) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    level = F.min(F.when(F.col("level") <= F.col("need"), F.struct("need", "nth", "level"))).over(over_all)["level"]
    return rows.select("source", "source_size", F.least("bound", F.coalesce(level, F.lit(float("inf"))) * F.col("w")).alias("target"))


def _ranked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows (source, size, u, odds) with their source's plan and rank; rank is null if there is no fraction."""
    joined = rows.join(plan, rows["source"].eqNullSafe(plan["source"]), "inner").drop(plan["source"])
    p = F.col("part")
    ratio = F.when((p > 0) & (F.col("odds") > 0), (F.col("u") / (1 - F.col("u"))) / ((p / (1 - p)) * F.col("odds")))
    return joined.withColumn("rank", ratio / (1 + ratio))


def _cut(ranked: DataFrame) -> DataFrame:
    """(source, low, cut): take ranks below low, and those up to cut."""
    found = ranked.where("rank is not null").select("source", "size", "rank", "wanted")
    at = F.least(F.floor(F.col("rank") * BINS), F.lit(BINS - 1)).cast("long")
    sub = F.least(F.floor(F.col("rank") * BINS * BINS), F.lit(BINS * BINS - 1)).cast("long")

    def boundary(rows: DataFrame, by: Column, base: Column) -> DataFrame:
        bins = rows.groupBy("source", "wanted", base.alias("base"), by.alias("bin")).agg(F.sum("size").alias("words"))
        w = Window.partitionBy("source").orderBy("bin")
        bins = bins.withColumn("upto", F.col("base") + F.sum("words").over(w))
        one = F.min(F.when(F.col("upto") >= F.col("wanted"), F.struct("bin", (F.col("upto") - F.col("words")).alias("base"))))
        return bins.groupBy("source").agg(one.alias("one")).select("source", F.col("one.bin").alias("bin"), F.col("one.base").alias("base"))

    def inside(rows: DataFrame, edge: DataFrame, by: Column) -> DataFrame:
        rows, edge = rows.drop("base"), edge.select(F.col("source").alias("s"), "bin", "base")
        return rows.join(edge, F.col("source").eqNullSafe(F.col("s")) & (by == F.col("bin")), "inner").drop("s", "bin")

    first = boundary(found, at, F.lit(0).cast("long"))
    within = inside(found, first, at)
    second = boundary(within, sub, F.col("base"))
    last = inside(within, second, sub).groupBy("source", "wanted", "base", "rank").agg(F.sum("size").alias("words"))
    w = Window.partitionBy("source").orderBy("rank")
    last = last.withColumn("before", F.col("base") + F.sum("words").over(w) - F.col("words"))
    # a group of equal ranks goes in if that brings the source nearer to its words
    cut = last.where(F.col("before") * 2 + F.col("words") <= F.col("wanted") * 2).groupBy("source").agg(F.max("rank").alias("cut"))
    cut = cut.select(F.col("source").alias("s"), "cut")
    edge = second.select("source", (F.col("bin") / F.lit(float(BINS * BINS))).alias("low"))
    return edge.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", odds: str | None = None, share: float = 1.5, most: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(plan, sized rows): plan has one row per source; sized has doc_id, source, size, u, odds for each row of docs."""
    weight = F.greatest(F.coalesce(F.col(odds).cast("double"), F.lit(0.0)), F.lit(0.0)) if odds else F.lit(1.0)
    sized = materialize(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), words(F.col(text)).alias("size"), uniform(F.col(key), F.col(text)).alias("u"), weight.alias("odds")))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(totals, share, most)
    r = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("whole", F.floor(r).cast("long")).withColumn("part", r - F.floor(r)).withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = materialize(plan)
    cut = _cut(_ranked(sized, plan)).select(F.col("source").alias("s"), "low", "cut")
    plan = plan.join(cut, plan["source"].eqNullSafe(cut["s"]), "left").drop("s")
    return materialize(plan), sized


def copies(ranked: DataFrame) -> Column:
    """How often a ranked row enters the mix."""
    extra = F.when(F.col("rank").isNull(), 0).when(F.col("low").isNull(), 1).when((F.col("rank") < F.col("low")) | (F.col("rank") <= F.col("cut")), 1).otherwise(0)
    return (F.col("whole") + extra).cast("long")


def mix_report(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", odds: str | None = None, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken), one for every row of docs.

    Null texts have size 0 and take 0 words. A null source is a source of its own, last in order. Rows equal in
    key and text have one rank and go in or stay out together. An empty table gives an empty result. Extra
    columns are ignored. `odds` names a column that multiplies inclusion odds (null or negative: never drawn
    beyond the certain copies).
    """
    plan, sized = mix(docs, text, source, key, odds, share, most)
    ranked = _ranked(sized, plan)
    return ranked.select("doc_id", "size", "source_size", "target", (copies(ranked) * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: rows of docs, with their columns, as often as they are taken."""
    plan, _ = mix(docs, text, source, key, None, share, most)
    held = free_name(docs, "row")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias(held))
    row = F.col(held)
    rows = rows.select(held, row[source].alias("source"), words(row[text]).alias("size"), uniform(row[key], row[text]).alias("u"), F.lit(1.0).alias("odds"))
    ranked = _ranked(rows, plan)
    return ranked.select(held, F.explode(F.array_repeat(F.lit(1), copies(ranked).cast("int")))).select(f"{held}.*")
