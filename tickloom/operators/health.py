"""Runtime health: message counts, sync states, warnings and suggested actions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.schemas import FUTURES

STATES = ("live_synced", "snapshot_seeded", "desynced", "resync_required", "unsynced", "fenced")


def message_stats(messages: DataFrame) -> DataFrame:
    """AGG-15: messages per channel, the last nonzero time and the last id of each symbol.

    messages has venue, symbol, channel, ts_ns, id. Works as an update-mode streaming aggregation too.
    """
    newest = F.struct("ts_ns", "id")
    return messages.groupBy("venue", "symbol").agg(
        F.count_if(F.col("channel") == "depth_v2").alias("depth_message_count"),
        F.count_if(F.col("channel") == "trade_v2").alias("trade_message_count"),
        F.max(F.nullif("ts_ns", F.lit(0))).alias("last_ts_ns"),
        F.max(newest)["id"].alias("last_id"),
    )


def sync_health(states: DataFrame) -> DataFrame:
    """AGG-13: per venue, symbols in each state, resyncs and update totals.

    states has one row per symbol: venue, sync_state, desync_events, resync_count, accepted, rejected, seeds.
    """
    return states.groupBy("venue").agg(
        *[F.count_if(F.col("sync_state") == s).alias(f"{s}_count") for s in STATES],
        F.count_if(F.coalesce("desync_events", F.lit(0)) > 0).alias("symbols_with_desyncs"),
        F.coalesce(F.max("resync_count"), F.lit(0)).alias("max_resync_count"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in ("accepted", "rejected", "seeds", "resync_count")],
    )


def coverage_ratio(per_symbol: DataFrame, requested: DataFrame) -> DataFrame:
    """AGG-14: symbols with messages over symbols asked for, to four decimals; null if none were asked for."""
    active = per_symbol.where("depth_message_count + trade_message_count > 0").groupBy("venue").agg(F.count(F.lit(1)).alias("active"))
    rows = requested.groupBy("venue").agg(F.count("symbol").alias("requested")).join(active, "venue", "left").na.fill(0, ["active"])
    return rows.withColumn("ratio", F.bround(F.try_divide(F.col("active"), F.col("requested")), 4))


def actions(selected: DataFrame, stats: DataFrame, observed_s: float) -> DataFrame:
    """JOI-07, PRJ-21, AGG-16: selected symbols with their counts (0 if unknown) and what to do about them."""
    rows = selected.select("venue", "symbol").distinct().join(stats.select("venue", "symbol", "depth_message_count", "trade_message_count"), ["venue", "symbol"], "left")
    rows = rows.na.fill(0, ["depth_message_count", "trade_message_count"])
    depth, trades = F.col("depth_message_count"), F.col("trade_message_count")
    return rows.withColumns({"no_data_reason": scalars.no_data_reason(depth, trades), "suggested_action": scalars.suggested_action(depth, trades, F.lit(observed_s))})


def subscribed(shards: DataFrame) -> DataFrame:
    """JOI-09: distinct symbols over all shards' lists; shards has venue and symbols (array)."""
    return shards.select("venue", F.explode("symbols").alias("symbol")).where("symbol is not null").distinct()


def zero_trade_warnings(selected: DataFrame, subscribed_symbols: DataFrame, liquid: DataFrame, stats: DataFrame, observed_s: float, least_s: float = 300.0) -> DataFrame:
    """JOI-06: liquid futures, selected and subscribed, whose depth is active while they have no trade."""
    if observed_s < least_s:
        return stats.limit(0).select("venue", "symbol", "depth_message_count", "trade_message_count")
    keys = ["venue", "symbol"]
    rows = stats.where((F.col("venue") == FUTURES) & (F.col("depth_message_count") > 0) & (F.col("trade_message_count") == 0))
    for other in (selected, subscribed_symbols, liquid):
        rows = rows.join(other.select(*keys).distinct(), keys, "left_semi")
    return rows.select(*keys, "depth_message_count", "trade_message_count")
