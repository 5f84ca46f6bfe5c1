"""A deterministic order-book and trade tape over the driver's `events` table, for queries and benchmarks.

symbol = user, session = ten days of the month, seq = event; a signup is a snapshot, every other event an update
whose ids chain unless the event is an error, which nothing but the next snapshot mends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.schemas import FUTURES, SPOT


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with whole nanoseconds, the number k of its props, and a venue by user."""
    rows = read(spark, sf_dir, "events")
    ts = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return rows.select(
        F.when(F.col("user_id") % 2 == 0, SPOT).otherwise(FUTURES).alias("venue"),
        F.col("user_id").cast("string").alias("symbol"),
        "event_id", "user_id", "event_type", "value", "ts", ts.alias("ts_ns"), F.coalesce(k, F.lit(0)).alias("k"),
        (F.floor((F.dayofmonth("ts") - 1) / 10) + 1).cast("long").alias("session"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as trade records; errors are lifecycle rows, some fields are missing, zero or no number."""
    e, i = events(spark, sf_dir), F.col("event_id")
    ms = F.expr("ts_ns div 1000000")
    return e.select(
        "venue", "symbol",
        F.when(F.col("event_type") == "error", "trade_stream_lifecycle").when(i % 3 != 0, "trade").alias("record_type"),
        F.col("session").alias("trade_stream_session_id"), i.alias("trade_session_seq"), F.lit("").alias("file"), F.lit(0).cast("bigint").alias("ordinal"),
        F.col("ts_ns").alias("ts_recv_ns"), F.when(i % 5 == 0, None).when(i % 5 == 1, 0).otherwise(ms + 1).alias("ts_event_ms"),
        F.when(i % 7 == 0, None).when(i % 7 == 1, 0).otherwise(ms).alias("ts_trade_ms"), F.when(i % 11 == 0, ms + 2).alias("exchange_ts_ms"),
        F.when(i % 97 == 0, "x").otherwise(F.concat(F.floor("value").cast("string"), F.lit("."), F.lpad((F.col("k") % 100).cast("string"), 2, "0"))).alias("price"),
        (F.col("k") % 10 + 1).cast("string").alias("quantity"), F.when(i % 13 != 0, i % 2 == 0).alias("is_buyer_maker"), F.col("k").alias("exchange_trade_id"),
    )


def depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as depth records, all by the spot rule, in the form that the replay takes."""
    e = events(spark, sf_dir)
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long")
    rows = e.withColumn("n", n)
    seed, last = F.col("event_type") == "signup", F.col("n") * 10 + 9
    level = F.array(F.array(F.floor("value").cast("string"), (F.col("k") % 10).cast("string")))
    buy = F.col("event_id") % 2 == 0
    return rows.select(
        F.lit(SPOT).alias("venue"), "symbol", "session", F.col("event_id").alias("seq"), F.lit("").alias("file"), F.lit(0).cast("bigint").alias("ordinal"),
        F.when(seed, "snapshot_seed").otherwise("depth_update").alias("record_type"), F.lit(None).cast("string").alias("state"), F.lit(None).cast("string").alias("reason"),
        F.when(~seed, F.col("n") * 10 + F.when(F.col("event_type") == "error", 3).otherwise(0)).alias("first_id"), F.when(~seed, last).alias("final_id"), F.lit(None).cast("bigint").alias("pu"), F.when(seed, last).alias("last_update_id"),
        F.when(buy, level).alias("bids"), F.when(~buy, level).alias("asks"), F.col("ts_ns").alias("ts_event"), F.col("ts_ns").alias("ts_init"),
    )


def futures_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """depth by the futures rule: updates name the last id before them (`pu`) and span it; errors do neither."""
    rows, last = depth(spark, sf_dir), F.col("final_id")
    broken = F.col("first_id") % 10 == 3
    first, pu = F.when(broken, last).otherwise(last - 10), F.when(broken, F.lit(-1)).otherwise(last - 10)
    return rows.withColumns({"venue": F.lit(FUTURES), "first_id": first, "pu": pu})


def two_sided_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """depth whose messages have the event's level as bid and that of the event before as ask."""
    rows = depth(spark, sf_dir)
    level = F.coalesce("bids", "asks")
    before = F.lag(level).over(Window.partitionBy("symbol").orderBy("seq"))
    return rows.withColumns({"bids": level, "asks": before})


# The same, in DuckDB SQL.
EVENTS_SQL = f"""ev AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN '{SPOT}' ELSE '{FUTURES}' END AS venue, user_id::VARCHAR AS symbol, event_id, user_id, event_type, value, ts,
         epoch_us(ts) * 1000 AS ts_ns, coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), 0) AS k, ((day(ts) - 1) // 10 + 1)::BIGINT AS session
  FROM events)"""
TRADES_SQL = (
    EVENTS_SQL
    + """, tr AS (
  SELECT venue, symbol, CASE WHEN event_type = 'error' THEN 'trade_stream_lifecycle' WHEN event_id % 3 <> 0 THEN 'trade' END AS record_type,
         session AS sid, event_id AS seq, ts_ns AS recv,
         CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE ts_ns // 1000000 + 1 END AS ev_ms,
         CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE ts_ns // 1000000 END AS tr_ms,
         CASE WHEN event_id % 11 = 0 THEN ts_ns // 1000000 + 2 END AS ex_ms,
         CASE WHEN event_id % 97 = 0 THEN 'x' ELSE floor(value)::BIGINT || '.' || lpad((k % 100)::VARCHAR, 2, '0') END AS price,
         (k % 10 + 1)::VARCHAR AS quantity, CASE WHEN event_id % 13 <> 0 THEN event_id % 2 = 0 END AS maker, k AS xid
  FROM ev)"""
)
DEPTH_SQL = (
    EVENTS_SQL
    + f""", numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM ev),
tape AS (
  SELECT '{SPOT}' AS venue, symbol, session, event_id AS seq, n, event_type = 'signup' AS seed, event_type = 'error' AS err, n * 10 + 9 AS last_id, ts_ns,
         floor(value)::BIGINT AS price, k % 10 AS size, CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side
  FROM numbered),
segmented AS (SELECT *, sum(seed::INT) OVER (PARTITION BY symbol, session ORDER BY seq) AS seg FROM tape),
judged AS (SELECT *, max(CASE WHEN err THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, session, seg ORDER BY seq) AS brk FROM segmented),
marked AS (SELECT *, NOT seed AND seg > 0 AND brk = 0 AS accepted FROM judged)"""
)
FENCES_SQL = (
    DEPTH_SQL
    + """, bad AS (SELECT *, min(seq) OVER (PARTITION BY symbol, session, seg) AS seg_first FROM marked WHERE NOT seed AND NOT accepted),
islands AS (SELECT venue, symbol, session, seg, min(seq) AS first_seq, max(seq) AS last_seq, min(ts_ns) AS start_ts FROM bad GROUP BY ALL),
following AS (SELECT symbol, seq, session, ts_ns, lead(ts_ns) OVER w AS next_ts, lead(session) OVER w AS next_session FROM tape WINDOW w AS (PARTITION BY symbol ORDER BY session, seq)),
fences AS (
  SELECT i.venue, i.symbol, i.session, start_ts, coalesce(next_ts, ts_ns) AS end_ts, CASE WHEN seg = 0 THEN 'no_snapshot_seed' ELSE 'continuity_break' END AS reason,
         coalesce(next_session = i.session, false) AS recovered
  FROM islands i JOIN following f ON i.symbol = f.symbol AND i.last_seq = f.seq)"""
)
