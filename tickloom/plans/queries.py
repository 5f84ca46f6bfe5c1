"""The registered queries of the engine and the SQL that DuckDB checks them with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.operators import catalog, health, instruments, quality, replay, trades, universe
from tickloom.plans import tape
from tickloom.plans.tape import DEPTH_SQL, EVENTS_SQL, FENCES_SQL, TRADES_SQL
from tickloom.schemas import FUTURES, SPOT
from tickloom.sources import raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


TICKERS_SQL = """tk AS (
  SELECT c_custkey AS ordinal,
         CASE WHEN c_custkey % 11 = 0 THEN c_custkey::VARCHAR WHEN c_custkey % 13 = 0 THEN 'é' || c_custkey WHEN c_custkey % 17 = 0 THEN 'X' WHEN c_custkey % 19 = 0 THEN 'b-' || c_custkey ELSE 'C' || c_custkey END || CASE WHEN c_custkey % 7 = 0 THEN 'BTC' ELSE 'USDT' END AS symbol,
         CASE WHEN c_custkey % 29 = 0 THEN 0 ELSE coalesce(v, 0) END::DOUBLE AS volume
  FROM customer LEFT JOIN (SELECT o_custkey, sum(floor(o_totalprice)::BIGINT) AS v FROM orders GROUP BY 1) ON c_custkey = o_custkey),
ranked AS (SELECT *, row_number() OVER (ORDER BY volume DESC, ordinal) AS rank FROM tk WHERE symbol LIKE '%USDT'),
pool AS (SELECT * FROM ranked WHERE rank <= 120),
reasoned AS (
  SELECT *, CASE WHEN regexp_matches(symbol, '[^\\x00-\\x7F]') THEN 'contains non-ASCII characters' WHEN NOT regexp_full_match(symbol, '[A-Z0-9]+USDT') THEN 'fails conservative regex ^[A-Z0-9]+USDT$'
         WHEN length(symbol) < 6 THEN 'base asset shorter than 2 chars (''' || symbol[1:length(symbol) - 4] || ''')' WHEN regexp_full_match(symbol, '[0-9]+USDT') THEN 'base asset is digits only' ELSE 'ok' END AS reason FROM pool),
flagged AS (SELECT *, reason = 'ok' AS sane, ordinal % 5 <> 0 AS supported, ordinal % 6 = 0 AS unhealthy FROM reasoned),
nth AS (
  SELECT *, CASE WHEN sane AND supported THEN count(*) FILTER (sane AND supported) OVER (ORDER BY rank) END AS nth_able, CASE WHEN sane AND supported AND NOT unhealthy THEN count(*) FILTER (sane AND supported AND NOT unhealthy) OVER (ORDER BY rank) END AS nth FROM flagged)"""


# --- trades -----------------------------------------------------------------------------------------------------

TICK_TS = "CASE WHEN coalesce(tr_ms, 0) <> 0 THEN tr_ms * 1000000 WHEN coalesce(ev_ms, 0) <> 0 THEN ev_ms * 1000000 ELSE recv END"
IS_TRADE = "coalesce(record_type, 'trade') = 'trade'"


@query(f"""WITH {TRADES_SQL}
SELECT venue, symbol, symbol || CASE WHEN venue LIKE '%USDTF%' THEN '-PERP' ELSE '' END || '.BINANCE' AS instrument_id, sid AS session, seq,
       price::DOUBLE AS price, quantity::DOUBLE AS size, CASE WHEN coalesce(maker, false) THEN 'SELLER' ELSE 'BUYER' END AS aggressor,
       CASE WHEN xid = 0 THEN '0' ELSE xid::VARCHAR END AS trade_id, {TICK_TS} AS ts_event, recv AS ts_init
FROM tr WHERE {IS_TRADE} AND price <> 'x'""")
def trade_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trades.to_ticks(tape.trades(spark, sf_dir)).withColumnsRenamed({"trade_stream_session_id": "session", "trade_session_seq": "seq"})
    return doubles(rows.drop("file", "ordinal"), "price", "size")


@query(f"""WITH {TRADES_SQL}
SELECT seq AS event_id, {TICK_TS} AS tick_ts, coalesce(tr_ms * 1000000, ev_ms * 1000000, recv) AS coverage_ts,
       CASE WHEN coalesce(ev_ms, 0) <> 0 THEN ev_ms * 1000000 WHEN coalesce(ex_ms, 0) <> 0 THEN ex_ms * 1000000 ELSE recv END AS depth_ts,
       coalesce(coalesce(nullif(tr_ms, 0), nullif(ev_ms, 0), ex_ms) * 1000000, recv) AS gap_ts
FROM tr""")
def trade_ts_fallback_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tape.trades(spark, sf_dir)
    trade, event, exchange, recv = (F.col(c) for c in ("ts_trade_ms", "ts_event_ms", "exchange_ts_ms", "ts_recv_ns"))
    return rows.select(
        F.col("trade_session_seq").alias("event_id"),
        scalars.trade_event_ns(trade, event, recv).alias("tick_ts"),
        scalars.coverage_event_ns(trade, event, recv).alias("coverage_ts"),
        scalars.depth_event_ns(event, exchange, recv).alias("depth_ts"),
        scalars.gap_event_ns(trade, event, exchange, recv).alias("gap_ts"),
    )


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols that the tape should have: all customers, of whom many never trade."""
    rows = tape.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return rows.select(F.when(F.col("k") % 2 == 0, SPOT).otherwise(FUTURES).alias("venue"), F.col("k").cast("string").alias("symbol"))


EXPECTED_SQL = f"expected AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN '{SPOT}' ELSE '{FUTURES}' END AS venue, c_custkey::VARCHAR AS symbol FROM customer)"
COVERAGE_SQL = f"""WITH {TRADES_SQL}, {EXPECTED_SQL},
found AS (
  SELECT venue, symbol, count(*) AS raw, count(*) FILTER ({IS_TRADE}) AS trades, count(*) FILTER (record_type = 'trade_stream_lifecycle') AS lifecycle,
         min(coalesce(tr_ms * 1000000, ev_ms * 1000000, recv)) FILTER ({IS_TRADE}) AS first_ts, max(coalesce(tr_ms * 1000000, ev_ms * 1000000, recv)) FILTER ({IS_TRADE}) AS last_ts
  FROM tr GROUP BY ALL),
covered AS (
  SELECT venue, symbol, coalesce(raw, 0) AS raw, coalesce(trades, 0) AS trades, coalesce(lifecycle, 0) AS lifecycle, first_ts, last_ts FROM expected FULL JOIN found USING (venue, symbol))"""


@query(f"{COVERAGE_SQL} SELECT * FROM covered")
def trade_coverage_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades.coverage(tape.trades(spark, sf_dir), _expected(spark, sf_dir))


def names_sql(condition: str) -> str:
    return f"coalesce(array_to_string(list_sort(list(DISTINCT CASE WHEN {condition} THEN symbol END) FILTER ({condition})), ','), '')"


@query(f"""{COVERAGE_SQL},
best AS (SELECT *, row_number() OVER (PARTITION BY venue ORDER BY trades DESC, symbol) AS nth FROM covered WHERE trades > 0)
SELECT venue, {names_sql('trades > 0')} AS with_trades, {names_sql('trades = 0')} AS without_trades, {names_sql('trades = 0 AND lifecycle > 0')} AS lifecycle_only, sum(trades)::BIGINT AS trades,
       (SELECT string_agg(symbol, ',' ORDER BY nth) FROM best b WHERE b.venue = c.venue AND nth <= 10) AS top
FROM covered c GROUP BY venue""")
def trade_coverage_by_venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades.coverage_by_venue(trade_coverage_by_symbol(spark, sf_dir))


@query(f"""WITH {TRADES_SQL}
SELECT venue, symbol, count(*) AS raw_records, count(*) FILTER ({IS_TRADE}) AS trade_records, count(*) FILTER (record_type = 'trade_stream_lifecycle') AS lifecycle_records,
       count(*) FILTER ({IS_TRADE} AND price <> 'x') AS ticks_written, count(*) FILTER ({IS_TRADE} AND price = 'x') AS bad_records,
       arg_min({TICK_TS}, (sid, seq)) FILTER ({IS_TRADE} AND price <> 'x') AS first_ts, arg_max({TICK_TS}, (sid, seq)) FILTER ({IS_TRADE} AND price <> 'x') AS last_ts
FROM tr GROUP BY ALL""")
def trade_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades.diagnostics(tape.trades(spark, sf_dir))


@query(f"""WITH {TRADES_SQL}
SELECT symbol, seq, xid AS exchange_trade_id, last_id FROM (SELECT *, lag(xid) OVER (PARTITION BY symbol, sid ORDER BY seq) AS last_id FROM tr WHERE {IS_TRADE}) WHERE xid <= last_id""")
def trade_id_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades.id_regressions(tape.trades(spark, sf_dir)).select("symbol", F.col("trade_session_seq").alias("seq"), "exchange_trade_id", "last_id")


@query(f"WITH {TRADES_SQL} SELECT venue, symbol, recv // 86400000000000 AS session, count(*) AS records FROM tr GROUP BY ALL HAVING count(*) FILTER ({IS_TRADE}) = 0")
def lifecycle_only_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days as sessions."""
    rows = tape.trades(spark, sf_dir).withColumn("trade_stream_session_id", F.expr("ts_recv_ns div 86400000000000"))
    return trades.lifecycle_only_sessions(rows).withColumnRenamed("trade_stream_session_id", "session")


FRAME = """'{"stream":"s","data":{"e":"trade","E":' || ts_ns // 1000000 || ',"s":"' || symbol || '"' || CASE WHEN event_id % 7 = 0 THEN '' ELSE ',"t":' || event_id END || ',"p":"1.5","q":"2","m":true}}'"""


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WebSocket frames out of events, some of them damaged."""
    e, i = tape.events(spark, sf_dir), F.col("event_id")
    body = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    ms = F.expr("ts_ns div 1000000").cast("string")
    spot = body('{"stream":"s","data":{"e":"trade","E":', ms, ',"s":"', F.col("symbol"), '"', F.when(i % 7 == 0, "").otherwise(body(',"t":', i.cast("string"))), ',"p":"1.5","q":"2","m":true}}')
    future = body('{"stream":"s","data":{"e":"aggTrade","E":', ms, ',"s":"', F.when(i % 17 == 0, "").otherwise(F.col("symbol")), '"', F.when(i % 5 == 0, "").otherwise(body(',"a":', i.cast("string"))), F.when(i % 11 == 0, "").otherwise(',"f":1,"l":2'), ',"p":"1.5","q":"2","T":', ms, ',"m":false}}')
    frame = F.when(i % 23 == 0, "{broken").when(i % 29 == 0, '{"result":null}').when(F.col("venue") == SPOT, spot).otherwise(future)
    return e.select("venue", (F.col("user_id") % 4).alias("shard"), i.alias("event_id"), frame.alias("frame"))


@query(f"""WITH {EVENTS_SQL}, judged AS (
  SELECT venue, user_id % 4 AS shard, CASE
    WHEN event_id % 23 = 0 THEN 'malformed_json' WHEN event_id % 29 = 0 THEN 'missing_combined_data'
    WHEN venue = '{SPOT}' THEN CASE WHEN event_id % 7 = 0 THEN 'missing_spot_trade_id' END
    WHEN event_id % 17 = 0 THEN 'missing_symbol' WHEN event_id % 5 = 0 THEN 'missing_futures_agg_trade_id' WHEN event_id % 11 = 0 THEN 'missing_futures_trade_id' END AS reason
  FROM ev)
SELECT venue, shard, reason, count(*) AS n FROM judged GROUP BY GROUPING SETS ((venue, shard, reason), (venue, reason))""")
def ingest_skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades.ingest_summary(_frames(spark, sf_dir))


@query(f"""WITH {EVENTS_SQL}
SELECT event_id, symbol, venue = '{FUTURES}' AS futures, CASE WHEN venue = '{FUTURES}' THEN event_id ELSE event_id END AS exchange_trade_id, ts_ns // 1000000 AS ts_event_ms,
       CASE WHEN venue = '{FUTURES}' THEN ts_ns // 1000000 END AS ts_trade_ms, venue = '{SPOT}' AS is_buyer_maker
FROM ev WHERE event_id % 23 <> 0 AND event_id % 29 <> 0 AND CASE WHEN venue = '{SPOT}' THEN event_id % 7 <> 0 ELSE event_id % 17 <> 0 AND event_id % 5 <> 0 AND event_id % 11 <> 0 END""")
def ingest_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trades.from_frames(_frames(spark, sf_dir))
    return rows.select("event_id", "symbol", (F.col("market_type") == "futures").alias("futures"), "exchange_trade_id", "ts_event_ms", "ts_trade_ms", "is_buyer_maker")


@query(f"""WITH {EVENTS_SQL} SELECT event_id, symbol, event_id AS first_id, event_id + 2 AS final_id, CASE WHEN venue = '{FUTURES}' THEN event_id - 1 END AS pu, ts_ns // 1000000 AS ts_event_ms, (k % 10)::VARCHAR AS size, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS asks
FROM ev WHERE event_id % 23 <> 0 AND event_id % 29 <> 0""")
def ingest_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth frames out of events: ids that differ in case only, and absent sides."""
    e, i = tape.events(spark, sf_dir), F.col("event_id")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    frame = text('{"data":{"e":"depthUpdate","E":', F.expr("ts_ns div 1000000"), ',"s":"', F.col("symbol"), '","U":', i, ',"u":', i + 2, F.when(F.col("venue") == FUTURES, text(',"pu":', i - 1)).otherwise(""), ',"b":[["1.5","', F.col("k") % 10, '"]]', F.when(i % 3 == 0, "").otherwise(',"a":[["2","1"]]'), "}}")
    rows = e.select("event_id", F.when(i % 23 == 0, "{").when(i % 29 == 0, '{"data":{}}').otherwise(frame).alias("frame"))
    return replay.from_frames(rows).select("event_id", "symbol", "first_id", "final_id", "pu", "ts_event_ms", F.col("bids")[0][1].alias("size"), F.size("asks").alias("asks"))


@query(f"""WITH {TICKERS_SQL} SELECT ordinal, CASE WHEN symbol LIKE '%USDT' THEN symbol[1:length(symbol) - 4] || '-USDT-PERP' ELSE symbol END AS perpetual, CASE WHEN ordinal % 14 BETWEEN 1 AND 10 THEN ordinal % 14 ELSE 10 END AS levels FROM tk""")
def names_and_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perpetual names, and how many book levels a request for some (0 to 13) gets."""
    rows = _tickers(spark, sf_dir)
    return rows.select("ordinal", scalars.perpetual_name(F.col("symbol")).alias("perpetual"), scalars.applied_levels(F.col("ordinal") % 14).alias("levels"))


# --- gaps and sequences -----------------------------------------------------------------------------------------

GAPS = "coalesce(max(gap), 0) AS {0}max_gap_ns, count(*) FILTER (gap > 1000000000) AS {0}over_1s, count(*) FILTER (gap > 5000000000) AS {0}over_5s, count(*) FILTER (gap > 60000000000) AS {0}over_60s"


@query(f"WITH {EVENTS_SQL} SELECT venue, symbol, {GAPS.format('')} FROM (SELECT *, ts_ns - lag(ts_ns) OVER (PARTITION BY symbol ORDER BY ts_ns) AS gap FROM ev) GROUP BY ALL")
def gap_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gap_stats(tape.events(spark, sf_dir).select("venue", "symbol", F.col("ts_ns").alias("ts")))


def _gap_sql(name: str, condition: str) -> str:
    return f"{name} AS (SELECT venue, symbol, {GAPS.format(name + '_')} FROM (SELECT *, ts_ns - lag(ts_ns) OVER (PARTITION BY symbol ORDER BY ts_ns) AS gap FROM ev WHERE {condition}) GROUP BY ALL)"


GAP_COLUMNS = [f"{n}_{c}" for n in ("depth", "trade", "snapshot") for c in ("max_gap_ns", "over_1s", "over_5s", "over_60s")] + ["session_boundaries", "shutdown_boundaries", "reconnect_boundaries"]


@query(f"""WITH {EVENTS_SQL}, {_gap_sql('depth', "event_type <> 'purchase'")}, {_gap_sql('trade', "event_type = 'purchase'")}, {_gap_sql('snapshot', "event_type = 'signup'")},
marks AS (
  SELECT venue, symbol, count(*) AS session_boundaries, count(*) FILTER (k % 3 = 0 AND k % 2 = 0) AS shutdown_boundaries, count(*) FILTER ((k % 3 = 0 OR k % 3 = 1) AND NOT (k % 3 = 0 AND k % 2 = 0)) AS reconnect_boundaries
  FROM ev WHERE event_type = 'error' GROUP BY ALL)
SELECT venue, symbol, {', '.join(f'coalesce({c}, 0) AS {c}' for c in GAP_COLUMNS)}
FROM depth FULL JOIN trade USING (venue, symbol) FULL JOIN snapshot USING (venue, symbol) FULL JOIN marks USING (venue, symbol)""")
def gap_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tape.events(spark, sf_dir).drop("ts").withColumnRenamed("ts_ns", "ts")
    kind = F.col("event_type")
    reason = F.when(F.col("k") % 3 == 0, "websocket_closed").when(F.col("k") % 3 == 1, "startup_or_reconnect").otherwise("shutdown")
    lifecycle = e.where(kind == "error").select("venue", "symbol", F.when(F.col("k") % 2 == 0, "session_end").otherwise("session_start").alias("event"), reason.alias("reason"))
    return quality.gap_diagnostics(e.where(kind != "purchase"), e.where(kind == "purchase"), e.where(kind == "signup"), lifecycle)


@query(f"WITH {EVENTS_SQL} SELECT symbol, session, event_id, row_number() OVER (PARTITION BY symbol, session ORDER BY event_id) AS session_seq FROM ev WHERE event_type <> 'error'")
def session_seq_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tape.events(spark, sf_dir).where("event_type <> 'error'").withColumn("arrival", F.col("event_id"))
    return replay.allocate_sequence(rows).select("symbol", "session", "event_id", "session_seq")


STATE = "CASE event_type WHEN 'signup' THEN 'snapshot_seeded' WHEN 'error' THEN 'desynced' WHEN 'purchase' THEN 'live_synced' ELSE 'resync_required' END"


@query(f"WITH {EVENTS_SQL} SELECT symbol, session, event_id AS seq, lag({STATE}) OVER (PARTITION BY symbol ORDER BY session, event_id) AS previous, {STATE} AS state FROM ev")
def sync_state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tape.events(spark, sf_dir).withColumns({"record_type": F.lit("sync_state"), "state": F.expr(STATE), "reason": F.lit(None).cast("string"), "seq": F.col("event_id"), "file": F.lit(""), "ordinal": F.lit(0)})
    return replay.state_log(rows).select("symbol", "session", "seq", "previous", "state")


@query(f"""WITH {EVENTS_SQL}, w AS (SELECT venue, symbol, event_id, count(*) OVER (PARTITION BY venue, symbol ORDER BY ts_ns // 1000000000 RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS in_window FROM ev)
SELECT event_id, in_window, in_window > 6 AS fenced FROM w""")
def resync_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tape.events(spark, sf_dir).withColumn("at_s", F.expr("ts_ns div 1000000000"))
    return replay.resync_budget(rows, seconds=86_400).select("event_id", "in_window", "fenced")


# --- replay -----------------------------------------------------------------------------------------------------


@query(f"WITH {DEPTH_SQL} SELECT symbol, session, seq, last_id AS sequence, ts_ns AS ts_event FROM marked WHERE accepted")
def replay_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = replay.replay(tape.depth(spark, sf_dir), ["accepted"], depth10=False)
    return rows.select("symbol", "session", "seq", "sequence", "ts_event")


@query(f"""WITH {DEPTH_SQL}
SELECT symbol, session, seq, CASE WHEN seed THEN 1 ELSE 0 END AS at, CASE WHEN size > 0 THEN 'UPDATE' ELSE 'DELETE' END AS action, side, price::DOUBLE AS price, size::DOUBLE AS size, CASE WHEN seed THEN 160 ELSE 128 END AS flags, last_id AS sequence, ts_ns AS ts_event
FROM marked WHERE accepted OR seed
UNION ALL SELECT symbol, session, seq, 0, 'CLEAR', NULL, NULL, NULL, 32, last_id, ts_ns FROM marked WHERE seed""")
def replay_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = replay.deltas(replay.replay(tape.depth(spark, sf_dir), ["delta"], depth10=False))
    return doubles(rows.select("symbol", "session", "seq", "at", "action", "side", "price", "size", "flags", "sequence", "ts_event"), "price", "size")


@query(f"WITH {FENCES_SQL} SELECT symbol, session, start_ts, end_ts, reason, recovered FROM fences")
def replay_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.fences(replay.replay(tape.depth(spark, sf_dir), ["fence"], depth10=False)).select("symbol", "session", "start_ts", "end_ts", "reason", "recovered")


@query(f"WITH {FENCES_SQL} SELECT symbol, session, start_ts, end_ts, reason, recovered FROM fences")
def replay_fences_by_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fences with one task per session instead of one per symbol."""
    return replay.fences(replay.replay(tape.depth(spark, sf_dir), ["fence"], depth10=False, by_session=True)).select("symbol", "session", "start_ts", "end_ts", "reason", "recovered")


@query(f"""WITH {FENCES_SQL}, counted AS (
  SELECT symbol, arg_min(ts_ns, (session, seq)) AS first_ts, arg_max(ts_ns, (session, seq)) AS last_ts, count(*) FILTER (NOT seed) AS updates, count(*) FILTER (seed) AS seeds,
         count(*) FILTER (NOT seed AND NOT accepted AND seg > 0) AS desyncs, count(*) FILTER (accepted OR seed) AS events FROM marked GROUP BY symbol)
SELECT *, (SELECT count(*) FROM fences f WHERE f.symbol = c.symbol) AS fences FROM counted c""")
def replay_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.metrics(replay.replay(tape.depth(spark, sf_dir), ["metrics"], depth10=False)).select("symbol", "first_ts", "last_ts", "updates", "seeds", "desyncs", "events", "fences")


@query(f"""WITH {DEPTH_SQL} SELECT symbol, seq, CASE WHEN seed THEN NULL ELSE (n * 10 + CASE WHEN err THEN 3 ELSE 0 END) <= lag(last_id) OVER w + 1 AND lag(last_id) OVER w + 1 <= last_id END AS follows
FROM tape WINDOW w AS (PARTITION BY symbol, session ORDER BY seq)""")
def continuity_diagnostic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tape.depth(spark, sf_dir)
    follows = F.when(F.col("record_type") == "depth_update", replay.continuity(rows))
    return rows.withColumn("follows", follows).select("symbol", "seq", "follows")


def _book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.books(replay.replay(tape.depth(spark, sf_dir), ["book"], depth10=False))


LEVELS_SQL = f"""WITH {DEPTH_SQL}, used AS (SELECT *, sum(seed::INT) OVER (PARTITION BY symbol ORDER BY session, seq) AS segment FROM marked WHERE accepted OR seed),
levels AS (
  SELECT symbol, side, price, arg_max(size, (session, seq)) AS size FROM used u WHERE segment = (SELECT max(segment) FROM used x WHERE x.symbol = u.symbol) GROUP BY ALL HAVING arg_max(size, (session, seq)) > 0)"""


@query(f"{LEVELS_SQL} SELECT symbol, side, price::DOUBLE AS price, size::DOUBLE AS size FROM levels")
def book_final_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(_book(spark, sf_dir).select("symbol", "side", "price", "size"), "price", "size")


@query(f"""{LEVELS_SQL}, placed AS (SELECT *, row_number() OVER (PARTITION BY symbol, side ORDER BY CASE WHEN side = 'BUY' THEN -price ELSE price END) AS level FROM levels)
SELECT symbol, side, level, price::DOUBLE AS price, size::DOUBLE AS size FROM placed WHERE level <= 10""")
def book_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(replay.best_levels(_book(spark, sf_dir)).select("symbol", "side", "level", "price", "size"), "price", "size")


@query()
def depth10_throttled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-level snapshots at least an hour apart, a greedy sample, as arrays; depth10_levels checks them by SQL."""
    return replay.depth10(replay.replay(tape.depth(spark, sf_dir), ["depth10"], interval_s=3600.0))


@query(f"""WITH RECURSIVE {DEPTH_SQL}, used AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY session, seq) AS place, sum(seed::INT) OVER (PARTITION BY symbol ORDER BY session, seq) AS segment FROM marked WHERE accepted OR seed),
changes AS (SELECT symbol, side, price, segment, place, size, lead(place) OVER (PARTITION BY symbol, segment, side, price ORDER BY place) AS until FROM used),
held AS (
  SELECT u.symbol, u.place, c.side, c.price, c.size, row_number() OVER (PARTITION BY u.symbol, u.place, c.side ORDER BY CASE WHEN c.side = 'BUY' THEN -c.price ELSE c.price END) AS level
  FROM used u JOIN changes c ON c.symbol = u.symbol AND c.segment = u.segment AND c.place <= u.place AND (c.until IS NULL OR c.until > u.place) WHERE c.size > 0),
shown AS (
  SELECT symbol, place, array_to_string(list(price || 'x' || size ORDER BY level) FILTER (side = 'BUY' AND level <= 10), ',') AS bids,
         array_to_string(list(price || 'x' || size ORDER BY level) FILTER (side = 'SELL' AND level <= 10), ',') AS asks FROM held GROUP BY ALL HAVING count(*) FILTER (side = 'BUY') > 0 AND count(*) FILTER (side = 'SELL') > 0),
able AS (SELECT u.symbol, u.session, u.seq, u.seed, u.last_id, u.ts_ns, s.bids, s.asks, row_number() OVER (PARTITION BY u.symbol ORDER BY u.place) AS nth FROM used u JOIN shown s ON u.symbol = s.symbol AND u.place = s.place),
given AS (
  SELECT able.*, ts_ns AS emitted, true AS emits FROM able WHERE nth = 1
  UNION ALL
  SELECT a.*, CASE WHEN a.seed OR a.ts_ns - g.emitted >= 3600000000000 THEN a.ts_ns ELSE g.emitted END, a.seed OR a.ts_ns - g.emitted >= 3600000000000 FROM able a JOIN given g ON a.symbol = g.symbol AND a.nth = g.nth + 1)
SELECT symbol, session, seq, bids, asks, last_id AS sequence, ts_ns AS ts_event FROM given WHERE emits""")
def depth10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-level snapshots at least an hour apart, their levels as text without the padding."""
    rows = depth10_throttled(spark, sf_dir)
    shown = lambda p, s: F.array_join(F.transform(F.filter(F.arrays_zip(F.col(p).alias("p"), F.col(s).alias("s")), lambda x: x["s"] != 0), lambda x: F.concat(x["p"].cast("long").cast("string"), F.lit("x"), x["s"].cast("long").cast("string"))), ",")
    return rows.select("symbol", "session", "seq", shown("bid_prices", "bid_sizes").alias("bids"), shown("ask_prices", "ask_sizes").alias("asks"), "sequence", "ts_event")


FUTURES_SQL = f"""{EVENTS_SQL}, numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM ev),
tape AS (SELECT symbol, session, event_id AS seq, n, event_type = 'signup' AS seed, event_type = 'error' AS err, n * 10 + 9 AS last_id, n * 10 - 1 AS pu, n * 10 AS first_id, ts_ns FROM numbered),
segmented AS (SELECT *, sum(seed::INT) OVER (PARTITION BY symbol, session ORDER BY seq) AS seg FROM tape),
placed AS (SELECT *, row_number() OVER (PARTITION BY symbol, session, seg ORDER BY seq) AS nth, lag(last_id) OVER (PARTITION BY symbol, session, seg ORDER BY seq) AS before FROM segmented),
judged AS (
  SELECT *, max(CASE WHEN seed THEN 0 WHEN nth = 2 AND seg > 0 THEN CASE WHEN err THEN 1 ELSE 0 END WHEN err OR pu <> before THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, session, seg ORDER BY seq) AS brk FROM placed)"""


@query(f"""WITH {FUTURES_SQL} SELECT symbol, session, seq, last_id AS sequence, ts_ns AS ts_event FROM judged WHERE NOT seed AND seg > 0 AND brk = 0""")
def replay_futures_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tape by the futures rule: the first update after a snapshot spans its id, later ones name the id before."""
    rows = replay.replay(tape.futures_depth(spark, sf_dir), ["accepted"], depth10=False)
    return rows.select("symbol", "session", "seq", "sequence", "ts_event")


@query(f"""WITH {FUTURES_SQL}, b AS (SELECT *, count(*) FILTER (NOT seed AND brk = 1 AND seg > 0) OVER (PARTITION BY symbol, session, seg ORDER BY seq) AS bad FROM judged)
SELECT symbol, count(*) FILTER (seed) AS seeds, count(*) FILTER (NOT seed AND seg > 0 AND brk = 0) AS accepted, count(*) FILTER (bad > 0 AND NOT seed) AS desyncs, count(*) FILTER (seg = 0) AS unseeded FROM b GROUP BY symbol""")
def replay_futures_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = replay.replay(tape.futures_depth(spark, sf_dir), ["metrics"], depth10=False)
    rows = replay.metrics(found)
    return rows.select("symbol", "seeds", (F.col("events") - F.col("seeds")).alias("accepted"), "desyncs", (F.col("updates") - (F.col("events") - F.col("seeds")) - F.col("desyncs")).alias("unseeded"))


@query(f"""WITH {DEPTH_SQL}, sided AS (SELECT *, lag(price) OVER w AS p1, lag(size) OVER w AS s1 FROM marked WINDOW w AS (PARTITION BY symbol ORDER BY seq)),
parts AS (
  SELECT symbol, seq, seed, last_id, ts_ns, 'BUY' AS side, price, size, 0 AS pos, 1 + (p1 IS NOT NULL)::INT AS levels FROM sided WHERE accepted OR seed
  UNION ALL SELECT symbol, seq, seed, last_id, ts_ns, 'SELL', p1, s1, 1, 2 FROM sided WHERE (accepted OR seed) AND p1 IS NOT NULL)
SELECT symbol, seq, pos + seed::INT AS at, CASE WHEN size > 0 THEN 'UPDATE' ELSE 'DELETE' END AS action, side, price::DOUBLE AS price, size::DOUBLE AS size, CASE WHEN seed THEN 32 ELSE 0 END + CASE WHEN pos = levels - 1 THEN 128 ELSE 0 END AS flags FROM parts
UNION ALL SELECT symbol, seq, 0, 'CLEAR', NULL, NULL, NULL, 32 FROM marked WHERE seed""")
def replay_two_sided_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a level on both sides: bids come first, and only the last level of an event has its flag."""
    rows = replay.deltas(replay.replay(tape.two_sided_depth(spark, sf_dir), ["delta"], depth10=False))
    return doubles(rows.select("symbol", "seq", "at", "action", "side", "price", "size", "flags"), "price", "size")


@query(f"""WITH {FENCES_SQL}, m AS (SELECT venue, symbol, count(*) AS raw_record_count, count(*) FILTER (seed) AS snapshot_seed_count, count(*) FILTER (NOT seed) AS depth_update_record_count, count(*) FILTER (accepted OR seed) AS deltas_written,
  count(*) FILTER (NOT seed AND NOT accepted AND seg > 0) AS desync_events, arg_min(ts_ns, (session, seq)) AS first_depth_ts_ns, arg_max(ts_ns, (session, seq)) AS last_depth_ts_ns FROM marked GROUP BY ALL),
f AS (SELECT venue, symbol, count(*) AS fenced_ranges, count(*) FILTER (NOT recovered) AS unrecovered FROM fences GROUP BY ALL),
g AS (SELECT venue, symbol, coalesce(max(gap), 0) AS depth_max_gap_ns, count(*) FILTER (gap > 60000000000) AS depth_over_60s FROM (SELECT *, ts_ns - lag(ts_ns) OVER (PARTITION BY symbol ORDER BY ts_ns) AS gap FROM marked WHERE NOT seed) GROUP BY ALL)
SELECT symbol, raw_record_count, snapshot_seed_count, depth_update_record_count, deltas_written, coalesce(fenced_ranges, 0) AS fenced_ranges, coalesce(unrecovered, 0) AS unrecovered, desync_events, first_depth_ts_ns, last_depth_ts_ns,
       coalesce(depth_max_gap_ns, 0) AS depth_max_gap_ns, coalesce(depth_over_60s, 0) AS depth_over_60s, deltas_written > 0 AS will_create_l2 FROM m LEFT JOIN f USING (venue, symbol) LEFT JOIN g USING (venue, symbol)""")
def depth_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's depth, one row per symbol."""
    records = tape.depth(spark, sf_dir)
    found = replay.replay(records, ["metrics", "fence"], depth10=False)
    times = records.where("record_type = 'depth_update'").select("venue", "symbol", F.col("ts_event").alias("ts"))
    gaps = quality.gap_diagnostics(times, times.limit(0), times.limit(0), times.limit(0).select("venue", "symbol", F.lit("").alias("event"), F.lit("").alias("reason")))
    rows = quality.depth_summary(replay.metrics(found), quality.fence_summary(replay.fences(found)), gaps, records)
    return rows.select(
        "symbol", "raw_record_count", "snapshot_seed_count", "depth_update_record_count", "deltas_written", "fenced_ranges", "unrecovered", "desync_events", "first_depth_ts_ns", "last_depth_ts_ns", "depth_max_gap_ns", "depth_over_60s", "will_create_l2",
    )


@query(f"WITH {TRADES_SQL}, {EXPECTED_SQL} SELECT venue, symbol FROM expected SEMI JOIN (SELECT venue, symbol FROM tr WHERE {IS_TRADE}) t USING (venue, symbol)")
def symbols_with_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.presence(tape.trades(spark, sf_dir), _expected(spark, sf_dir))


def _fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.fences(replay.replay(tape.depth(spark, sf_dir), ["fence"], depth10=False))


SEVERITY_SQL = FENCES_SQL + ", graded AS (SELECT *, CASE WHEN recovered AND reason <> 'no_snapshot_seed' THEN 'medium' ELSE 'high' END AS severity FROM fences)"


@query(f"WITH {SEVERITY_SQL} SELECT venue, symbol, count(*) FILTER (severity = 'low') AS fenced_low, count(*) FILTER (severity = 'medium') AS fenced_medium, count(*) FILTER (severity = 'high') AS fenced_high, count(*) FILTER (NOT recovered) AS unrecovered FROM graded GROUP BY ALL")
def fence_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fence_summary(_fences(spark, sf_dir))


@query(f"WITH {SEVERITY_SQL}, nth AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY start_ts, session, end_ts) AS nth FROM graded) SELECT symbol, nth, start_ts, end_ts, reason, severity FROM nth WHERE nth <= 3")
def fence_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fence_examples(_fences(spark, sf_dir)).select("symbol", "nth", "start_ts", "end_ts", "reason", "severity")


RAW_REASONS = ("bootstrap_start", "WebSocket_Closed", "shutdown", "continuity_break", "desynced", "snapshot_failed", "rate_limited", "resync_limit_exceeded", "other")


@query(f"""WITH {EVENTS_SQL}, r AS (SELECT event_id, [{', '.join(f"'{r}'" for r in RAW_REASONS)}][event_id % {len(RAW_REASONS)} + 1] AS raw, k % 2 = 0 AS recovered FROM ev),
n AS (SELECT *, CASE event_id % 9 WHEN 0 THEN 'bootstrap' WHEN 1 THEN 'websocket_closed' WHEN 2 THEN 'shutdown' WHEN 3 THEN 'continuity_break' WHEN 4 THEN 'desynced' WHEN 5 THEN 'no_snapshot_seed' WHEN 6 THEN 'rate_limit_resync' WHEN 7 THEN 'rate_limit_resync' ELSE 'unknown' END AS reason FROM r)
SELECT event_id, raw, recovered, reason, CASE WHEN reason IN ('bootstrap', 'shutdown') THEN 'low' WHEN reason = 'websocket_closed' AND NOT recovered THEN 'low' WHEN reason = 'no_snapshot_seed' OR NOT recovered THEN 'high' ELSE 'medium' END AS severity FROM n""")
def fence_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.get(F.array(*map(F.lit, RAW_REASONS)), (F.col("event_id") % len(RAW_REASONS)).cast("int"))
    rows = tape.events(spark, sf_dir).select("event_id", raw.alias("raw"), (F.col("k") % 2 == 0).alias("recovered")).withColumn("reason", scalars.fence_reason(F.col("raw")))
    return rows.withColumn("severity", scalars.fence_severity(F.col("reason"), F.col("recovered")))


# --- readiness and integrity ------------------------------------------------------------------------------------


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade and depth figures of every symbol; depth sits on the spot venue, trades on the user's."""
    per_trade = trades.diagnostics(tape.trades(spark, sf_dir)).select("venue", "symbol", F.col("ticks_written").alias("ticks"), F.col("trade_records").alias("trades"), F.col("lifecycle_records").alias("lifecycle"))
    per_depth = replay.metrics(replay.replay(tape.depth(spark, sf_dir), ["metrics"], depth10=False)).select("venue", "symbol", F.col("events").alias("depth_events"), "depth10s")
    return quality.ready(quality.joined_stats(per_trade, per_depth), least_trades=3)


READY_SQL = f"""WITH {DEPTH_SQL}, {TRADES_SQL.split('FROM events), ', 1)[1]},
t AS (SELECT venue, symbol, count(*) FILTER ({IS_TRADE} AND price <> 'x') AS ticks, count(*) FILTER ({IS_TRADE}) AS trades, count(*) FILTER (record_type = 'trade_stream_lifecycle') AS lifecycle FROM tr GROUP BY ALL),
d AS (SELECT venue, symbol, count(*) FILTER (accepted OR seed) AS depth_events FROM marked GROUP BY ALL),
j AS (SELECT venue, symbol, coalesce(ticks, 0) AS ticks, coalesce(trades, 0) AS trades, coalesce(lifecycle, 0) AS lifecycle, coalesce(depth_events, 0) AS depth_events, 0::BIGINT AS depth10s FROM t FULL JOIN d USING (venue, symbol)),
ready AS (
  SELECT *, CASE WHEN depth_events > 0 AND ticks > 0 THEN 'full_ready' WHEN depth_events > 0 THEN 'l2_ready' WHEN ticks > 0 THEN 'trade_only' ELSE 'not_ready' END AS readiness,
         trades = 0 AND lifecycle > 0 AS lifecycle_only, depth_events > 0 AND ticks > 0 AND trades >= 3 AS eligible FROM j)"""


@query(f"{READY_SQL} SELECT * FROM ready")
def readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir)


@query(f"""{READY_SQL} SELECT venue, {', '.join(f"count(*) FILTER (readiness = '{c}') AS {c}" for c in ('full_ready', 'l2_ready', 'trade_only', 'not_ready'))},
{names_sql('eligible')} AS suggested, {names_sql('lifecycle_only')} AS lifecycle_only FROM ready GROUP BY venue""")
def readiness_by_venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.readiness_by_venue(_stats(spark, sf_dir))


@query(f"""{READY_SQL}, {EXPECTED_SQL}, e AS (SELECT expected.*, coalesce(ticks, 0) AS ticks, coalesce(trades, 0) AS trades, coalesce(depth_events, 0) AS depth_events FROM expected LEFT JOIN ready USING (venue, symbol))
SELECT count(*) FILTER (ticks > 0) AS with_trades, count(*) FILTER (depth_events > 0) AS with_depth, count(*) FILTER (ticks > 0 AND depth_events > 0) AS with_both, count(*) FILTER (trades = 0 AND depth_events = 0) AS without_data,
       array_to_string(list_sort(list(venue || '/' || symbol) FILTER (trades = 0 AND depth_events = 0))[1:20], ',') AS first_without_data FROM e""")
def data_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _expected(spark, sf_dir).join(_stats(spark, sf_dir), ["venue", "symbol"], "left").na.fill(0)
    return quality.data_presence(rows.withColumnRenamed("trades", "raw_trades"))


@query(f"""WITH e AS (SELECT r_name AS venue, n_name AS symbol FROM nation JOIN region ON n_regionkey = r_regionkey),
s AS (SELECT DISTINCT n_name AS symbol FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 8000), c AS (SELECT DISTINCT n_name AS symbol FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 9500),
m AS (SELECT e.*, s.symbol IS NOT NULL AS raw, c.symbol IS NOT NULL AS done FROM e LEFT JOIN s USING (symbol) LEFT JOIN c USING (symbol))
SELECT venue, count(*) AS expected, count(*) FILTER (raw) AS raw, count(*) FILTER (done) AS converted, {names_sql('NOT raw')} AS missing_raw, {names_sql('NOT done')} AS missing_converted FROM m GROUP BY venue""")
def integrity_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as venues, nations as symbols; nations with well-off suppliers have data."""
    keys = tape.read(spark, sf_dir, "nation").join(tape.read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("venue"), F.col("n_name").alias("symbol"), "n_nationkey")
    rich = lambda least: tape.read(spark, sf_dir, "supplier").where(F.col("s_acctbal") > least).join(keys, F.col("s_nationkey") == F.col("n_nationkey")).select("venue", "symbol")
    return quality.integrity(keys, rich(8000), rich(9500))


@query("""WITH p AS (SELECT n_name AS venue, l_suppkey AS symbol, count(*) AS lines, sum(l_quantity)::BIGINT AS quantity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
SELECT venue, symbol, sum(lines)::BIGINT AS lines, sum(quantity)::BIGINT AS quantity, GROUPING_ID(venue, symbol)::INT AS level FROM p GROUP BY ROLLUP (venue, symbol)""")
def venue_symbol_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tape.read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("long").alias("quantity"))
    sites = tape.read(spark, sf_dir, "supplier").join(tape.read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = lines.join(sites, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("n_name").alias("venue"), F.col("l_suppkey").alias("symbol"), "lines", "quantity")
    return quality.roll_up(rows, ["lines", "quantity"])


@query(f"WITH {EVENTS_SQL}, p AS (SELECT event_type AS kind, symbol, min(ts_ns) AS first_ts, max(ts_ns) AS last_ts FROM ev GROUP BY ALL) SELECT kind, min(first_ts) AS start_ts, max(last_ts) AS end_ts FROM p GROUP BY kind")
def ts_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ts_ranges(tape.events(spark, sf_dir).groupBy(F.col("event_type").alias("kind"), "symbol").agg(F.min("ts_ns").alias("first_ts"), F.max("ts_ns").alias("last_ts")))


@query(f"""WITH {EVENTS_SQL}, {EXPECTED_SQL}, p AS (SELECT DISTINCT venue, symbol FROM ev), m AS (SELECT count(*) AS expected, count(p.symbol) AS raw FROM expected LEFT JOIN p USING (venue, symbol))
SELECT expected, raw, coalesce(raw::DOUBLE / nullif(expected, 0), 0.0) AS ratio, expected >= 50 AND coalesce(raw::DOUBLE / nullif(expected, 0), 0.0) < 0.8 AS refused FROM m""")
def raw_coverage_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.overwrite_guard(_expected(spark, sf_dir), tape.events(spark, sf_dir))


# --- universe ---------------------------------------------------------------------------------------------------


def _tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as tickers: quote volume is what they ordered, in whole units; some names are odd."""
    spent = tape.read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(F.floor("o_totalprice")).alias("v"))
    rows = tape.read(spark, sf_dir, "customer").join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
    k = F.col("c_custkey")
    name = F.when(k % 11 == 0, k.cast("string")).when(k % 13 == 0, F.concat(F.lit("é"), k.cast("string"))).when(k % 17 == 0, "X").when(k % 19 == 0, F.concat(F.lit("b-"), k.cast("string"))).otherwise(F.concat(F.lit("C"), k.cast("string")))
    symbol = F.concat(name, F.when(k % 7 == 0, "BTC").otherwise("USDT"))
    volume = F.when(k % 29 == 0, "bad").otherwise(F.coalesce("v", F.lit(0)).cast("string"))
    return rows.select(k.alias("ordinal"), symbol.alias("symbol"), volume.alias("quoteVolume"))


def _selection(spark: SparkSession, sf_dir: str) -> universe.Selection:
    rows = _tickers(spark, sf_dir)
    return universe.select(rows, universe.SPOT_POOL, rows.where("ordinal % 5 <> 0").select("symbol"), rows.where("ordinal % 6 = 0 and symbol <> 'XUSDT'").select("symbol"))


@query(f"WITH {TICKERS_SQL} SELECT rank, symbol, volume, ordinal FROM pool")
def universe_rank_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.rank(_tickers(spark, sf_dir), universe.SPOT_POOL).select("rank", "symbol", "volume", "ordinal")


@query(f"WITH {TICKERS_SQL} SELECT nth, symbol, volume FROM nth WHERE nth <= 50")
def universe_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selection(spark, sf_dir).selected


@query(f"WITH {TICKERS_SQL} SELECT symbol FROM nth WHERE nth <= 50 AND nth_able > 50")
def universe_replacements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selection(spark, sf_dir).replacements


@query(f"""WITH {TICKERS_SQL} SELECT rank, symbol, volume, CASE WHEN NOT sane THEN 'sanity' WHEN NOT supported THEN 'support' ELSE 'health' END AS stage,
       CASE WHEN NOT sane THEN reason WHEN NOT supported THEN '{universe.SPOT_UNSUPPORTED}' ELSE '{universe.UNHEALTHY}' END AS reason FROM flagged WHERE NOT sane OR NOT supported OR unhealthy""")
def universe_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selection(spark, sf_dir).rejects


@query(f"""WITH {TICKERS_SQL} SELECT count(*) AS pool, count(*) FILTER (sane) AS after_sanity, count(nth_able) AS after_support, count(nth) AS after_health, count(*) FILTER (nth <= 50) AS selected,
       array_to_string((list(symbol ORDER BY rank) FILTER (NOT sane))[1:12], ',') AS rejected_sample, true AS support_available FROM nth""")
def universe_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selection(spark, sf_dir).funnel


@query(f"WITH {TICKERS_SQL} SELECT ordinal, symbol, reason FROM reasoned")
def symbol_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.sane(universe.rank(_tickers(spark, sf_dir), universe.SPOT_POOL)).select("ordinal", "symbol", "reason")


@query(f"""WITH {TICKERS_SQL}, b AS (SELECT ordinal, symbol, CASE WHEN symbol LIKE '%USDT' AND length(symbol) > 4 THEN symbol[1:length(symbol) - 4] END AS base FROM tk)
SELECT ordinal, array_to_string(list_filter([CASE WHEN regexp_matches(symbol, '[^\\x00-\\x7F]') THEN 'contains non-ASCII characters' END, CASE WHEN length(base) < 2 THEN 'base asset shorter than 2 chars (''' || base || ''')' END,
  CASE WHEN NOT regexp_matches(base, '[^\\x00-\\x7F]') AND regexp_matches(base, '[^A-Za-z0-9]') THEN 'unexpected base asset characters' END, CASE WHEN base IS NULL THEN 'unexpected symbol structure for quote USDT' END], lambda x: x IS NOT NULL), '; ') AS warnings FROM b""")
def symbol_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tickers(spark, sf_dir).select("ordinal", scalars.symbol_warnings(F.col("symbol")).alias("warnings"))


@query("""SELECT s.venue, floor((n - 1) / 25)::INT AS shard, count(*) AS symbols, string_agg(lower(symbol) || '@depth@100ms', '/' ORDER BY n) AS streams
FROM (SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'a' ELSE 'b' END AS venue, 'C' || c_custkey AS symbol, row_number() OVER (PARTITION BY c_nationkey % 2 ORDER BY c_custkey) AS n FROM customer) s GROUP BY ALL""")
def stream_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tape.read(spark, sf_dir, "customer")
    return universe.shards(rows.select(F.when(F.col("c_nationkey") % 2 == 0, "a").otherwise("b").alias("venue"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"), F.col("c_custkey").alias("ordinal")))


# --- health -----------------------------------------------------------------------------------------------------


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message counts of user-days; views are depth, purchases trades, and the first k is the time watched."""
    e = tape.events(spark, sf_dir)
    return e.groupBy("venue", "symbol", F.date_format("ts", "yyyy-MM-dd").alias("date")).agg(
        F.count_if(F.col("event_type") == "view").alias("depth_message_count"), F.count_if(F.col("event_type") == "purchase").alias("trade_message_count"), (F.max("k") * 10).cast("double").alias("observation_sec")
    )


@query(f"""WITH {EVENTS_SQL}, days AS (
  SELECT venue, symbol, strftime(ts, '%Y-%m-%d') AS date, count(*) FILTER (event_type = 'view') = 0 AND count(*) FILTER (event_type = 'purchase') = 0 AND max(k) * 10 >= 300 AS zero FROM ev GROUP BY ALL),
b AS (SELECT *, max(CASE WHEN zero THEN 0 ELSE 1 END) OVER (PARTITION BY venue, symbol ORDER BY date DESC) AS broken FROM days),
s AS (SELECT venue, symbol, count(*) FILTER (broken = 0) AS zero_runs, min(date) FILTER (broken = 0) AS streak_date FROM b GROUP BY ALL)
SELECT *, zero_runs >= 2 AND coalesce(date_diff('day', streak_date::DATE, DATE '2024-02-01') <= 15, false) AS excluded FROM s""")
def health_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.health_streaks(_days(spark, sf_dir), F.to_date(F.lit("2024-02-01")), exclude_days=14)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    channel = F.when(kind.isin("view", "click"), "depth_v2").when((kind == "purchase") & (F.col("k") % 20 == 0), "trade_v2").otherwise("lifecycle")
    return tape.events(spark, sf_dir).select("venue", "symbol", channel.alias("channel"), "ts_ns", F.col("event_id").alias("id"))


STATS_SQL = f"""{EVENTS_SQL}, st AS (SELECT venue, symbol, count(*) FILTER (event_type IN ('view', 'click')) AS depth_message_count, count(*) FILTER (event_type = 'purchase' AND k % 20 = 0) AS trade_message_count, max(ts_ns) AS last_ts_ns, arg_max(event_id, (ts_ns, event_id)) AS last_id FROM ev GROUP BY ALL)"""


@query(f"WITH {STATS_SQL} SELECT * FROM st")
def message_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.message_stats(_messages(spark, sf_dir))


@query(f"""WITH {STATS_SQL}, {EXPECTED_SQL}, j AS (SELECT venue, symbol, coalesce(depth_message_count, 0) AS depth_message_count, coalesce(trade_message_count, 0) AS trade_message_count FROM expected LEFT JOIN st USING (venue, symbol))
SELECT *, CASE WHEN depth_message_count = 0 AND trade_message_count = 0 THEN 'zero_depth_and_trade_messages' WHEN depth_message_count = 0 THEN 'zero_depth_messages' WHEN trade_message_count = 0 THEN 'zero_trade_messages' END AS no_data_reason,
       CASE WHEN depth_message_count = 0 AND trade_message_count = 0 THEN 'temporary_exclude_candidate' WHEN depth_message_count = 0 THEN 'watch' ELSE 'keep' END AS suggested_action FROM j""")
def health_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.actions(_expected(spark, sf_dir), message_stats(spark, sf_dir), 400.0)


@query(f"""WITH {STATS_SQL}, {EXPECTED_SQL} SELECT venue, count(*) AS requested, count(*) FILTER (coalesce(depth_message_count, 0) + coalesce(trade_message_count, 0) > 0) AS active,
round_even(count(*) FILTER (coalesce(depth_message_count, 0) + coalesce(trade_message_count, 0) > 0)::DOUBLE / count(*), 4) AS ratio FROM expected LEFT JOIN st USING (venue, symbol) GROUP BY venue""")
def heartbeat_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _expected(spark, sf_dir)
    return health.coverage_ratio(message_stats(spark, sf_dir).join(wanted, ["venue", "symbol"], "left_semi"), wanted)


@query(f"""WITH {EVENTS_SQL}, last AS (SELECT venue, symbol, arg_max({STATE}, (session, event_id)) AS state, count(*) FILTER (event_type = 'error') AS desyncs, count(*) FILTER (event_type = 'logout') AS resyncs, count(*) FILTER (event_type = 'purchase') AS accepted, count(*) FILTER (event_type = 'click') AS rejected, count(*) FILTER (event_type = 'signup') AS seeds FROM ev GROUP BY ALL)
SELECT venue, {', '.join(f"count(*) FILTER (state = '{s}') AS {s}_count" for s in health.STATES)}, count(*) FILTER (desyncs > 0) AS symbols_with_desyncs, coalesce(max(resyncs), 0) AS max_resync_count,
       sum(accepted)::BIGINT AS total_accepted, sum(rejected)::BIGINT AS total_rejected, sum(seeds)::BIGINT AS total_seeds, sum(resyncs)::BIGINT AS total_resync_count FROM last GROUP BY venue""")
def heartbeat_sync_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, n = F.col("event_type"), F.count_if
    rows = tape.events(spark, sf_dir).groupBy("venue", "symbol").agg(
        F.max_by(F.expr(STATE), F.struct("session", "event_id")).alias("sync_state"), n(kind == "error").alias("desync_events"), n(kind == "logout").alias("resync_count"),
        n(kind == "purchase").alias("accepted"), n(kind == "click").alias("rejected"), n(kind == "signup").alias("seeds"),
    )
    return health.sync_health(rows)


@query(f"""WITH {STATS_SQL} SELECT venue, symbol, depth_message_count, trade_message_count FROM st WHERE venue = '{FUTURES}' AND depth_message_count > 0 AND trade_message_count = 0 AND symbol::BIGINT % 3 <> 0""")
def futures_zero_trade_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = message_stats(spark, sf_dir)
    number = F.col("symbol").cast("bigint")
    shards = stats.groupBy("venue", (number % 4).alias("shard")).agg(F.collect_set("symbol").alias("symbols"))
    return health.zero_trade_warnings(stats, health.subscribed(shards), stats.where(number % 3 != 0), stats, 400.0)


# --- instruments and catalog ------------------------------------------------------------------------------------


def _instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as instruments: the price's cents give the tick, every fifth part has no exchange information."""
    parts = tape.read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    keyed = parts.select(F.when(k % 2 == 0, SPOT).otherwise(FUTURES).alias("venue"), F.concat(F.lit("P"), k.cast("string"), F.lit("USDT")).alias("symbol"), "p_partkey", "p_size")
    tick = F.when(k % 3 == 0, "0.01000000").when(k % 3 == 1, "0.00010000").otherwise("1.00000000")
    filters = F.array(
        F.struct(F.lit("PRICE_FILTER").alias("filterType"), tick.alias("tickSize"), F.lit(None).cast("string").alias("stepSize"), F.lit(None).cast("string").alias("minQty"), F.lit(None).cast("string").alias("minNotional")),
        F.struct(F.lit("LOT_SIZE").alias("filterType"), F.lit(None).cast("string").alias("tickSize"), F.lit("0.00100000").alias("stepSize"), F.lit("0.01000000").alias("minQty"), F.lit(None).cast("string").alias("minNotional")),
        F.struct(F.lit("NOTIONAL").alias("filterType"), F.lit(None).cast("string").alias("tickSize"), F.lit(None).cast("string").alias("stepSize"), F.lit(None).cast("string").alias("minQty"), F.col("p_size").cast("string").alias("minNotional")),
    )
    info = keyed.where("p_partkey % 5 <> 0").select("venue", "symbol", F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("baseAsset"), F.lit("USDT").alias("quoteAsset"), filters.alias("filters"))
    return instruments.build(keyed, info)


INSTRUMENTS_SQL = f"""ins AS (
  SELECT CASE WHEN p_partkey % 2 = 0 THEN '{SPOT}' ELSE '{FUTURES}' END AS venue, 'P' || p_partkey || 'USDT' AS symbol, 'P' || p_partkey || 'USDT' || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '-PERP' END || '.BINANCE' AS instrument_id,
         'P' || p_partkey AS base, 'USDT' AS quote, CASE WHEN p_partkey % 5 = 0 OR p_partkey % 3 = 0 THEN 2 WHEN p_partkey % 3 = 1 THEN 4 ELSE 0 END AS price_precision, CASE WHEN p_partkey % 5 = 0 THEN 5 ELSE 3 END AS size_precision,
         CASE WHEN p_partkey % 5 = 0 OR p_partkey % 3 = 0 THEN '0.01' WHEN p_partkey % 3 = 1 THEN '0.0001' ELSE '1' END AS price_increment, CASE WHEN p_partkey % 5 = 0 THEN '0.00001' ELSE '0.001' END AS size_increment,
         CASE WHEN p_partkey % 5 = 0 THEN '0.00001' ELSE '0.010' END AS min_quantity, CASE WHEN p_partkey % 5 = 0 THEN 5.0 ELSE p_size END::DOUBLE AS min_notional, p_partkey % 2 <> 0 AS perpetual
  FROM part)"""


@query(f"WITH {INSTRUMENTS_SQL} SELECT * FROM ins")
def instrument_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _instruments(spark, sf_dir)


@query(f"""WITH {DEPTH_SQL}, {TRADES_SQL.split('FROM events), ', 1)[1]}
SELECT symbol || CASE WHEN venue LIKE '%USDTF%' THEN '-PERP' ELSE '' END || '.BINANCE' AS instrument_id, count(*) AS n, 'trade_ticks' AS kind FROM tr WHERE {IS_TRADE} AND price <> 'x' GROUP BY ALL
UNION ALL SELECT symbol || '.BINANCE', count(*), 'deltas' FROM marked WHERE accepted OR seed GROUP BY ALL""")
def catalog_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tape's ticks and deltas written as a catalog, in files of few rows, and counted there; a row per instrument and
    kind comes back before the catalog goes."""
    root = f"{spark.conf.get('spark.checkpoint.dir', None) or spark.conf.get('spark.sql.warehouse.dir')}/tickloom-catalog-{uuid.uuid4().hex}"
    changes = replay.deltas(replay.replay(tape.depth(spark, sf_dir), ["delta"], depth10=False))
    changes = changes.withColumn("instrument_id", scalars.instrument_id(F.col("venue"), F.col("symbol")))
    try:
        catalog.write(trades.to_ticks(tape.trades(spark, sf_dir)), root, "trade_ticks", "2024-01-01", ["ts_init", *trades.ORDER], 50)
        catalog.write(changes, root, "deltas", "2024-01-01", ["ts_init", "session", "seq", "at"])
        rows = catalog.inspect(spark, root).collect()
    finally:
        raw.delete(spark, root)
    return spark.createDataFrame(rows, "instrument_id string, n long, kind string")


@query(f"""WITH {INSTRUMENTS_SQL} SELECT instrument_id, count(*) AS n, sum(l_quantity)::BIGINT AS quantity FROM lineitem JOIN ins ON symbol = 'P' || l_partkey || 'USDT' WHERE price_precision > 0 GROUP BY ALL""")
def records_join_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_partkey")
    rows = tape.read(spark, sf_dir, "lineitem").select(F.when(k % 2 == 0, SPOT).otherwise(FUTURES).alias("venue"), F.concat(F.lit("P"), k.cast("string"), F.lit("USDT")).alias("symbol"), "l_quantity")
    return instruments.attach(rows, _instruments(spark, sf_dir).where("price_precision > 0")).groupBy("instrument_id").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 7 = 3 AND o_orderdate::DATE <= DATE '2001-06-17' AND o_orderdate::DATE + 30 >= DATE '2001-06-17' AND o_orderkey % 9 <> 0""")
def purge_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as catalog files of a month each; some names hold no range."""
    rows = tape.read(spark, sf_dir, "orders")
    stamp = lambda d: F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T00-00-00-000000000Z"))
    name = F.when(F.col("o_orderkey") % 9 == 0, "part-0.parquet").otherwise(F.concat(stamp(F.col("o_orderdate")), F.lit("_"), stamp(F.date_add("o_orderdate", 30)), F.lit(".parquet")))
    files = rows.select("o_orderkey", "o_custkey", (F.col("o_custkey") % 7).cast("string").alias("instrument_id"), name.alias("name"))
    return catalog.files_to_purge(files, ["3"], "2001-06-17").select("o_orderkey", "o_custkey")


@query("""WITH d AS (SELECT o_orderpriority AS host, epoch(date_trunc('month', o_orderdate))::BIGINT AS at_s, count(*)::DOUBLE AS gb FROM orders GROUP BY ALL),
g AS (SELECT *, gb - first_value(gb) OVER (PARTITION BY host ORDER BY at_s ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS growth_gb FROM d)
SELECT *, CASE WHEN growth_gb > 0 THEN (480.0 - gb) / growth_gb END AS days_left FROM g""")
def disk_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.unix_seconds(F.date_trunc("month", F.col("o_orderdate").cast("timestamp")))
    rows = tape.read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("host"), at.alias("at_s")).agg(F.count(F.lit(1)).cast("double").alias("gb"))
    return quality.disk_growth(rows, ring=12)


@query("""WITH d AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS dt, count(*)::DOUBLE AS gb FROM orders GROUP BY ALL), n AS (SELECT *, row_number() OVER (ORDER BY dt) AS nth, 1000.0 - coalesce(sum(gb) OVER (ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before_gb FROM d)
SELECT * FROM n WHERE nth <= 10 AND before_gb > 950""")
def disk_oldest_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tape.read(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt")).agg(F.count(F.lit(1)).cast("double").alias("gb"))
    return quality.oldest_dates(rows, 1000.0, 950.0)


@query(f"WITH {EVENTS_SQL} SELECT event_id, strftime(timezone('Europe/Budapest', timezone('UTC', ts)), '%Y-%m-%dT%H:%M:%S') AS local_time FROM ev")
def report_time_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tape.events(spark, sf_dir).select("event_id", F.substring(scalars.report_time(F.col("ts").cast("timestamp")), 1, 19).alias("local_time"))
