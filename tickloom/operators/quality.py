"""Quality reports: gaps, fences, readiness, presence, integrity and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import scalars

KEYS = ["venue", "symbol"]
NANOS = 1_000_000_000


def gap_stats(times: DataFrame, prefix: str = "") -> DataFrame:
    """AGG-06: of each symbol's sorted times (column ts): the largest gap and how many exceed 1, 5 and 60 seconds.

    Gaps are in nanoseconds, so nothing is rounded. One shuffle; the sort spills.
    """
    rows = times.select(*KEYS, "ts", F.lag("ts").over(Window.partitionBy(*KEYS).orderBy("ts")).alias("before"))
    gap = F.col("ts") - F.col("before")
    over = [F.count_if(gap > s * NANOS).alias(f"{prefix}over_{s}s") for s in (1, 5, 60)]
    return rows.groupBy(*KEYS).agg(F.coalesce(F.max(gap), F.lit(0)).alias(f"{prefix}max_gap_ns"), *over)


def gap_diagnostics(depth: DataFrame, trades: DataFrame, snapshots: DataFrame, lifecycle: DataFrame) -> DataFrame:
    """AGG-07: gaps of depth updates, trades (informational) and snapshots, and lifecycle boundaries.

    The first three have venue, symbol, ts; lifecycle has venue, symbol, event, reason; every lifecycle row is a boundary (T23).
    """
    closed = (F.col("event") == "session_end") & (F.col("reason") == "websocket_closed")
    again = F.coalesce(F.col("reason").contains("reconnect") | (F.col("reason") == "websocket_closed"), F.lit(False))
    marks = lifecycle.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("session_boundaries"),
        F.count_if(F.coalesce(closed, F.lit(False))).alias("shutdown_boundaries"),
        F.count_if(again & ~F.coalesce(closed, F.lit(False))).alias("reconnect_boundaries"),
    )
    rows = gap_stats(depth, "depth_").join(gap_stats(trades, "trade_"), KEYS, "full_outer").join(gap_stats(snapshots, "snapshot_"), KEYS, "full_outer").join(marks, KEYS, "full_outer")
    return rows.na.fill(0)


def fence_summary(fences: DataFrame) -> DataFrame:
    """AGG-08."""
    return fences.groupBy(*KEYS).agg(*[F.count_if(F.col("severity") == s).alias(f"fenced_{s}") for s in ("low", "medium", "high")], F.count_if(~F.col("recovered")).alias("unrecovered"))


def fence_examples(fences: DataFrame, n: int = 3) -> DataFrame:
    """AGG-09: the first n fences of each symbol."""
    first = Window.partitionBy(*KEYS).orderBy("start_ts", "session", "end_ts")
    return fences.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= n)


FIGURES = ["ticks", "trades", "lifecycle", "depth_events", "depth10s"]


def ready(per_symbol: DataFrame, least_trades: int = 1) -> DataFrame:
    """PRJ-20: class of each symbol, and whether it may enter the suggested universe (T26).

    per_symbol has venue, symbol and FIGURES: ticks written, raw trades and lifecycle rows, depth events and
    ten-level snapshots written.
    """
    depth = (F.col("depth_events") > 0) | (F.col("depth10s") > 0)
    rows = per_symbol.withColumn("readiness", scalars.readiness(depth, F.col("ticks") > 0))
    eligible = (F.col("readiness") == "full_ready") & (F.col("trades") >= least_trades)
    return rows.withColumns({"lifecycle_only": (F.col("trades") == 0) & (F.col("lifecycle") > 0), "eligible": eligible})


def joined_stats(trades: DataFrame, depth: DataFrame) -> DataFrame:
    """JOI-03: trade and depth figures of every symbol that either side knows; missing figures are 0."""
    rows = trades.select(*KEYS, *FIGURES[:3]).join(depth.select(*KEYS, *FIGURES[3:]), KEYS, "full_outer")
    return rows.na.fill(0, FIGURES)


def readiness_by_venue(rows: DataFrame) -> DataFrame:
    """AGG-11: counts by class; the suggested and the lifecycle-only symbols as sorted, comma-joined lists."""
    named = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("symbol").cast("string")))), ",")
    return rows.groupBy("venue").agg(
        *[F.count_if(F.col("readiness") == c).alias(c) for c in ("full_ready", "l2_ready", "trade_only", "not_ready")],
        named(F.col("eligible")).alias("suggested"),
        named(F.col("lifecycle_only")).alias("lifecycle_only"),
    )


def data_presence(rows: DataFrame) -> DataFrame:
    """AGG-12: symbols with ticks, with depth, with both, and without any raw record (T25).

    rows has venue, symbol, raw_trades, ticks, depth_events.
    """
    tick, depth, none = F.col("ticks") > 0, F.col("depth_events") > 0, (F.col("raw_trades") == 0) & (F.col("depth_events") == 0)
    first = F.array_join(F.slice(F.array_sort(F.collect_set(F.when(none, F.concat_ws("/", "venue", F.col("symbol").cast("string"))))), 1, 20), ",")
    return rows.agg(F.count_if(tick).alias("with_trades"), F.count_if(depth).alias("with_depth"), F.count_if(tick & depth).alias("with_both"), F.count_if(none).alias("without_data"), first.alias("first_without_data"))


def integrity(expected: DataFrame, raw: DataFrame, converted: DataFrame) -> DataFrame:
    """AGG-21 and SET-02/03: per venue how many symbols are expected, present and converted, and which are missing.

    All three have venue, symbol; only expected symbols count.
    """
    keys = expected.select(*KEYS).distinct()
    marked = keys.join(raw.select(*KEYS).distinct().withColumn("raw", F.lit(1)), KEYS, "left").join(converted.select(*KEYS).distinct().withColumn("done", F.lit(1)), KEYS, "left")
    missing = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c.isNull(), F.col("symbol").cast("string")))), ",")
    return marked.groupBy("venue").agg(
        F.count(F.lit(1)).alias("expected"), F.count("raw").alias("raw"), F.count("done").alias("converted"),
        missing(F.col("raw")).alias("missing_raw"), missing(F.col("done")).alias("missing_converted"),
    )


def overwrite_guard(expected: DataFrame, raw: DataFrame, least: float = 0.8, from_symbols: int = 50, allow: bool = False, staging: bool = False) -> DataFrame:
    """AGG-20: refuse to overwrite a day when too few of many expected symbols have raw depth."""
    keys = expected.select(*KEYS).distinct()
    marked = keys.join(raw.select(*KEYS).distinct().withColumn("raw", F.lit(1)), KEYS, "left")
    rows = marked.agg(F.count(F.lit(1)).alias("expected"), F.count("raw").alias("raw"))
    ratio = F.coalesce(F.try_divide(F.col("raw"), F.col("expected")), F.lit(0.0))
    refuse = (F.col("expected") >= from_symbols) & (ratio < least) & F.lit(not allow and not staging)
    return rows.select("expected", "raw", ratio.alias("ratio"), refuse.alias("refused"))


def roll_up(per_symbol: DataFrame, sums: list[str]) -> DataFrame:
    """AGG-05: sums per symbol, per venue and in total; level is 0, 1, 3."""
    return per_symbol.rollup(*KEYS).agg(*[F.sum(c).alias(c) for c in sums], F.grouping_id().cast("int").alias("level"))


def ts_ranges(rows: DataFrame) -> DataFrame:
    """AGG-10: earliest start and latest end of each output type; rows has kind, first_ts, last_ts."""
    return rows.groupBy("kind").agg(F.min("first_ts").alias("start_ts"), F.max("last_ts").alias("end_ts"))


def presence(records: DataFrame, expected: DataFrame, record_type: str = "trade") -> DataFrame:
    """JOI-08: expected symbols with a raw record of a type; a missing type counts as trade on every channel (T24)."""
    found = records.where(F.coalesce("record_type", F.lit("trade")) == record_type).select(*KEYS)
    return expected.select(*KEYS).join(found, KEYS, "left_semi")


def disk_growth(samples: DataFrame, ring: int = 288, budget_gb: float = 480.0) -> DataFrame:
    """AGG-22: growth per day over a ring of samples (host, at_s, gb) and days until the budget is full.

    The ring may span more than a day but growth is read as one day's, as the report does (T33).
    """
    w = Window.partitionBy("host").orderBy("at_s").rowsBetween(-(ring - 1), 0)
    rows = samples.withColumn("growth_gb", F.col("gb") - F.first_value("gb").over(w))
    return rows.withColumn("days_left", F.when(F.col("growth_gb") > 0, (F.lit(budget_gb) - F.col("gb")) / F.col("growth_gb")))


def oldest_dates(dirs: DataFrame, used_gb: float, target_gb: float, attempts: int = 10) -> DataFrame:
    """AGG-23: the oldest date directories (dt, gb) whose removal brings usage to the target, at most `attempts`."""
    dated = dirs.where(F.col("dt").rlike(r"^\d{4}-\d{2}-\d{2}\z"))
    w = Window.orderBy("dt")
    freed = F.coalesce(F.sum("gb").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return dated.withColumn("nth", F.row_number().over(w)).withColumn("before_gb", F.lit(used_gb) - freed).where((F.col("nth") <= attempts) & (F.col("before_gb") > target_gb))




def depth_summary(per_depth: DataFrame, per_fence: DataFrame, gaps: DataFrame, records: DataFrame) -> DataFrame:
    """AGG-04: one row per symbol of a day's depth: records by type, what was written, fences, gaps, continuity."""
    keys = ["venue", "symbol"]
    raw = records.groupBy(*keys).agg(F.count(F.lit(1)).alias("raw_record_count"))
    names = {
        "snapshots": "snapshot_seed_count", "updates": "depth_update_record_count", "sync_rows": "sync_state_record_count", "lifecycle_rows": "stream_lifecycle_record_count",
        "events": "deltas_written", "depth10s": "depth10_written", "fences": "fenced_ranges", "desyncs": "desync_events", "resyncs": "resync_count", "first_ts": "first_depth_ts_ns", "last_ts": "last_depth_ts_ns",
    }
    rows = per_depth.select(*keys, *[F.col(c).alias(n) for c, n in names.items()], "bad")
    rows = rows.withColumn("will_create_l2", F.col("deltas_written") > 0)
    for more in (raw, per_fence, gaps):
        rows = rows.join(more, keys, "left")
    return rows.na.fill(0)
