"""Universe selection: rank, cap, sanity, support, health, top N. Every stage keeps what it rejects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import scalars

# Sizes of the pools and limits of the health feedback.
TOP, SPOT_POOL, FUTURES_POOL, SAMPLE = 50, 120, 200, 12
LEAST_OBSERVED_S, ZERO_RUNS, EXCLUDE_DAYS = 300.0, 2, 1
# Why the stages after sanity reject.
SPOT_UNSUPPORTED = "not found in spot exchangeInfo TRADING USDT symbols"
FUTURES_UNSUPPORTED = "not found in futures exchangeInfo TRADING symbols"
UNHEALTHY = "temporarily_unhealthy_zero_messages"


def rank(tickers: DataFrame, pool: int, quote: str = "USDT") -> DataFrame:
    """TOP-01: the pool of largest quote volumes; ties keep their input order (column ordinal).

    tickers has symbol, quoteVolume (text), ordinal. The rank is one row per symbol, so its single sort is small.
    """
    rows = tickers.where(F.col("symbol").endswith(quote)).withColumn("volume", scalars.safe_float(F.col("quoteVolume")))
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("volume"), "ordinal"))).where(F.col("rank") <= pool)


def sane(pool: DataFrame) -> DataFrame:
    """SET-06: one flag column, read twice by whoever needs both sides."""
    return pool.withColumn("reason", scalars.sanity_reason(F.col("symbol"))).withColumn("sane", F.col("reason") == "ok")


def supported(pool: DataFrame, trading: DataFrame | None) -> tuple[DataFrame, bool]:
    """JOI-04: flag `supported`. An unknown or empty set of trading symbols supports everything (T30)."""
    if trading is None or not trading.limit(1).count():
        return pool.withColumn("supported", F.lit(True)), False
    known = trading.select("symbol").distinct().withColumn("supported", F.lit(True))
    return pool.join(known, "symbol", "left").na.fill(False, ["supported"]), True


def health_streaks(days: DataFrame, today: Column, least_observed_s: float = LEAST_OBSERVED_S, runs: int = ZERO_RUNS, exclude_days: int = EXCLUDE_DAYS) -> DataFrame:
    """AGG-18: trailing days without any message per symbol, and whether they exclude it today.

    days has venue, symbol, date (text), observation_sec, depth_message_count, trade_message_count. The streak
    ends at the first day, from the newest back, that had messages or was watched too briefly. Exclusion counts
    from the streak's oldest day (T31).
    """
    zero = (F.coalesce("observation_sec", F.lit(0.0)) >= least_observed_s) & (F.coalesce("depth_message_count", F.lit(0)) == 0) & (F.coalesce("trade_message_count", F.lit(0)) == 0)
    newest = Window.partitionBy("venue", "symbol").orderBy(F.desc("date"))
    rows = days.select("venue", "symbol", "date", zero.alias("zero")).withColumn("broken", F.max(~F.col("zero")).over(newest.rowsBetween(Window.unboundedPreceding, 0)))
    out = rows.groupBy("venue", "symbol").agg(F.count_if(~F.col("broken")).alias("zero_runs"), F.min(F.when(~F.col("broken"), F.col("date"))).alias("streak_date"))
    # a date that cannot be read excludes
    recent = F.coalesce(F.date_diff(today, F.try_to_date("streak_date")) <= exclude_days + 1, F.lit(True))
    return out.withColumn("excluded", (F.col("zero_runs") >= runs) & F.col("streak_date").isNotNull() & recent)


@dataclass
class Selection:
    """Ranked rows with the flags of every stage, the selected and the replacing symbols, the funnel, and the rejected
    (rank, symbol, volume, stage, reason), each by the first stage that rejects it."""

    rows: DataFrame
    selected: DataFrame
    replacements: DataFrame
    funnel: DataFrame
    rejects: DataFrame


def select(tickers: DataFrame, pool: int, trading: DataFrame | None = None, excluded: DataFrame | None = None, top: int = TOP, unsupported: str = SPOT_UNSUPPORTED) -> Selection:
    """TOP-02: the top symbols after sanity, support and health; replacements only got in through health.

    The pool is capped before any filter, and rejects are not filled up from beyond it (T29).
    """
    flagged, available = supported(sane(rank(tickers, pool)), trading)
    if excluded is None:
        flagged = flagged.withColumn("unhealthy", F.lit(False))
    else:
        flagged = flagged.join(excluded.select("symbol").distinct().withColumn("unhealthy", F.lit(True)), "symbol", "left").na.fill(False, ["unhealthy"])
    able, well = F.col("sane") & F.col("supported"), F.col("sane") & F.col("supported") & ~F.col("unhealthy")
    upto = Window.orderBy("rank")
    rows = flagged.withColumns({"nth_able": F.when(able, F.count_if(able).over(upto)), "nth": F.when(well, F.count_if(well).over(upto))})
    chosen = rows.where(F.col("nth") <= top)
    funnel = rows.agg(
        F.count(F.lit(1)).alias("pool"),
        F.count_if("sane").alias("after_sanity"),
        F.count_if(able).alias("after_support"),
        F.count_if(well).alias("after_health"),
        F.count_if(F.col("nth") <= top).alias("selected"),
        F.array_join(F.slice(F.transform(F.array_sort(F.collect_list(F.when(~F.col("sane"), F.struct("rank", "symbol")))), lambda x: x["symbol"]), 1, SAMPLE), ",").alias("rejected_sample"),
        F.lit(available).alias("support_available"),
    )
    stage = F.when(~F.col("sane"), "sanity").when(~F.col("supported"), "support").when(F.col("unhealthy"), "health")
    why = F.when(~F.col("sane"), F.col("reason")).when(~F.col("supported"), unsupported).otherwise(UNHEALTHY)
    rejects = rows.withColumn("stage", stage).where("stage is not null").select("rank", "symbol", "volume", "stage", why.alias("reason"))
    return Selection(rows, chosen.select("nth", "symbol", "volume"), chosen.where(F.col("nth_able") > top).select("symbol"), funnel, rejects)


def shards(symbols: DataFrame, size: int = 25) -> DataFrame:
    """PRJ-25: shard numbers from 0, `size` symbols of a venue each in their order, and each shard's stream names."""
    rows = symbols.withColumn("shard", F.floor((F.row_number().over(Window.partitionBy("venue").orderBy("ordinal")) - 1) / size).cast("int"))
    names = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", F.lower("symbol").alias("s")))), lambda x: F.concat(x["s"], F.lit("@depth@100ms")))
    return rows.groupBy("venue", "shard").agg(F.count(F.lit(1)).alias("symbols"), F.array_join(names, "/").alias("streams"))
