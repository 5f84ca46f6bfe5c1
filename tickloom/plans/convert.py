"""The daily conversion: raw records of one date to the catalog, and its quality report."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import catalog, instruments, quality, replay, trades
from tickloom.schemas import VENUES
from tickloom.sources import raw

REPORT_FIELDS = ("status", "date", "symbols", "trades", "depth", "totals", "readiness", "integrity", "architecture")
ARCHITECTURE = "spark_native_committed_order"


def stored(df: DataFrame, root: str) -> DataFrame:
    """df through a Parquet table in a work folder: scans and folds that several outputs share run once."""
    path = f"{root}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def convert_date(spark: SparkSession, raw_root: str, meta_root: str, out_root: str, date: str, interval_s: float = 1.0, depth10: bool = True, allow_partial: bool = False, staging: bool = False, by_session: bool = False) -> dict:
    """Convert a date and return its report.

    No symbols give status `no_data`; too little raw depth refuses (status `refused_partial_raw_depth`) before the
    catalog is touched, unless allowed or staged; no output gives `empty`.
    """
    began = time.time()
    universe = raw.resolve_universe(spark, raw_root, meta_root, date, VENUES)
    if not universe:
        return {"status": "no_data", "date": date, "architecture": ARCHITECTURE}
    root = f"{out_root}.staging.{uuid.uuid4().hex}" if staging else out_root
    work = f"{out_root}.work.{uuid.uuid4().hex}"
    try:
        report = _converted(spark, raw_root, universe, root, work, date, interval_s, depth10, allow_partial, staging, by_session)
        report["runtime_sec"] = round(time.time() - began, 3)
        if staging and report["status"] == "ok":
            catalog.swap(spark, root, out_root)
        return report
    finally:
        raw.delete(spark, work)
        if staging:
            raw.delete(spark, root)


def _converted(spark: SparkSession, raw_root: str, universe: dict[str, list[str]], root: str, work: str, date: str, interval_s: float, depth10: bool, allow_partial: bool, staging: bool, by_session: bool) -> dict:
    expected = spark.createDataFrame([(v, s) for v, symbols in universe.items() for s in symbols], "venue string, symbol string")
    depth = stored(replay.prepared(raw.read_channel(spark, raw_root, "depth_v2", date=date)), work)
    ticks_in = stored(raw.read_channel(spark, raw_root, "trade_v2", date=date).drop("native_payload"), work)
    info = None
    for venue in universe:
        rows = raw.exchange_info(spark, raw_root, venue, date)
        info = rows if info is None else info.union(rows)
    known = stored(instruments.build(expected, info), work)
    guard = quality.overwrite_guard(expected, depth.select("venue", "symbol").distinct(), allow=allow_partial, staging=staging).first().asDict()
    if guard["refused"]:
        return {"status": "refused_partial_raw_depth", "date": date, "guard": guard, "architecture": ARCHITECTURE}
    depth, ticks_in = (instruments.attach(x, known) for x in (depth, ticks_in))
    folded = stored(replay.replay(depth, interval_s=interval_s, depth10=depth10, by_session=by_session), work)
    ids = known.select("venue", "symbol", "instrument_id")
    ticks = trades.to_ticks(ticks_in.drop("instrument_id"))
    # an instrument that gives no rows this time must not keep those of an earlier run
    catalog.purge(spark, root, [r["instrument_id"] for r in ids.select("instrument_id").distinct().collect()], date)
    catalog.write(ticks, root, "trade_ticks", date, ["ts_init", *trades.ORDER])
    canonical = ["ts_init", "session", "seq"]
    catalog.write(replay.deltas(folded).join(ids, ["venue", "symbol"]), root, "deltas", date, [*canonical, "at"])
    catalog.write(replay.depth10(folded).join(ids, ["venue", "symbol"]), root, "depth10", date, canonical)
    catalog.write(replay.fences(folded).join(ids, ["venue", "symbol"]), root, "fences", date, ["start_ts", "end_ts"])
    report = _report(expected, known, ticks_in, depth, folded)
    return report | {"status": "ok" if report["totals"].get("events") or report["totals"].get("ticks_written") else "empty", "date": date, "architecture": ARCHITECTURE, "guard": guard}


def _report(expected: DataFrame, known: DataFrame, ticks_in: DataFrame, depth: DataFrame, folded: DataFrame) -> dict:
    """Aggregates of a day: a few rows per symbol, collected to assemble one document."""
    rows = lambda df: [r.asDict(recursive=True) for r in df.collect()]
    keys = ["venue", "symbol"]
    per_trade = trades.diagnostics(ticks_in)
    per_depth, fences = replay.metrics(folded), replay.fences(folded)
    stats = quality.joined_stats(
        per_trade.select(*keys, F.col("ticks_written").alias("ticks"), F.col("trade_records").alias("trades"), F.col("lifecycle_records").alias("lifecycle")),
        per_depth.select(*keys, F.col("events").alias("depth_events"), "depth10s"),
    )
    ready = quality.ready(expected.join(stats, keys, "left").na.fill(0))
    times = lambda df, c: df.select(*keys, F.col(c).alias("ts"))
    gaps = quality.gap_diagnostics(
        times(depth.where("record_type = 'depth_update'"), "ts_event"),
        times(trades.parsed(ticks_in), "ts_event"),
        times(replay.depth10(folded), "ts_event"),
        depth.where("record_type = 'stream_lifecycle'").select(*keys, F.lit(None).cast("string").alias("event"), "reason"),
    )
    sums = ["ticks", "trades", "lifecycle", "depth_events", "depth10s"]
    total = quality.roll_up(ready, sums).where("level = 3").first()
    return {
        "symbols": rows(known.select("venue", "symbol", "instrument_id")),
        "trades": rows(per_trade),
        "depth": rows(quality.depth_summary(per_depth, quality.fence_summary(fences), gaps, depth)),
        "gaps": rows(gaps),
        "fences": rows(quality.fence_summary(fences)),
        "fence_examples": rows(quality.fence_examples(fences)),
        "readiness": rows(quality.readiness_by_venue(ready)),
        "integrity": rows(quality.integrity(expected, depth, per_depth.where("events > 0"))),
        "totals": {"ticks_written": int(total["ticks"] or 0), "events": int(total["depth_events"] or 0), "depth10s": int(total["depth10s"] or 0)} if total else {},
    }


def validate_report(report: dict) -> list[str]:
    """VAL-01: what is missing or foreign in a report."""
    found = [f"missing {f}" for f in REPORT_FIELDS if f not in report]
    return found + ([] if report.get("architecture") == ARCHITECTURE else ["foreign architecture"])


def save_report(spark: SparkSession, report: dict, *paths: str) -> None:
    """SNK-09: the same document at every path."""
    for path in paths:
        raw.save_text(spark, path, json.dumps(report, indent=2, sort_keys=True, default=str))
