"""Readers, trades, quality, universe, instruments, conversion, catalog and streaming."""

from __future__ import annotations

import gzip
import json
import os
import shutil

import zstandard
from pyspark.sql import Row
from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.operators import catalog, health, instruments, quality, trades, universe
from tickloom.plans import convert, universe_cache
from tickloom.schemas import FUTURES, SPOT
from tickloom.sources import raw
from tickloom.streaming import jobs, sync

DAY = "2026-04-17"


def put(root, venue, channel, symbol, name, records, extra=""):
    folder = os.path.join(root, venue, channel, symbol, DAY)
    os.makedirs(folder, exist_ok=True)
    data = ("\n".join(map(json.dumps, records)) + "\n" + extra).encode()
    packed = zstandard.compress(data) if name.endswith("zst") else gzip.compress(data) if name.endswith("gz") else data
    with open(os.path.join(folder, name), "wb") as f:
        f.write(packed)


def trade(seq, price="100.0", session=1, **more):
    return {"record_type": "trade", "trade_stream_session_id": session, "trade_session_seq": seq, "ts_recv_ns": seq * 10**9, "ts_trade_ms": seq * 1000, "price": price, "quantity": "1", "is_buyer_maker": seq % 2 == 0, "exchange_trade_id": 12345} | more


def update(seq, u, **more):
    return {"record_type": "depth_update", "stream_session_id": 1, "session_seq": seq, "ts_recv_ns": seq * 10**9, "U": u, "u": u, "payload": {"bids": [["99.5", "2"]], "asks": [["100.5", "1"]]}} | more


def snapshot(seq, last):
    return {"record_type": "snapshot_seed", "stream_session_id": 1, "session_seq": seq, "ts_recv_ns": seq * 10**9, "lastUpdateId": last, "payload": {"bids": [["99", "1"]], "asks": [["101", "1"]]}}


def lay_out(root):
    put(root, SPOT, "trade_v2", "BTCUSDT", f"{DAY}T10.jsonl.zst", [trade(3, "102.0"), trade(1, "100.0")])
    put(root, SPOT, "trade_v2", "BTCUSDT", f"{DAY}T11.jsonl", [trade(2, "101.0"), {"record_type": "trade_stream_lifecycle", "trade_stream_session_id": 1, "ts_recv_ns": 1}], extra="{broken\n\n")
    put(root, SPOT, "depth_v2", "BTCUSDT", f"{DAY}T10.jsonl.gz", [update(3, 103), snapshot(1, 101), update(2, 102)])
    put(root, FUTURES, "trade_v2", "ETHUSDT", f"{DAY}T10.jsonl", [{"record_type": "trade_stream_lifecycle", "ts_recv_ns": 1}])
    info = {"venue": SPOT, "ts_recv_ns": 1, "symbols": [{"symbol": "BTCUSDT", "status": "TRADING", "baseAsset": "BTC", "quoteAsset": "USDT", "isSpotTradingAllowed": True, "filters": [{"filterType": "PRICE_FILTER", "tickSize": "0.01000000"}]}, {"symbol": "UTKUSDT", "status": "BREAK", "quoteAsset": "USDT"}]}
    put(root, SPOT, "exchangeinfo", "ALL", f"{DAY}T00.jsonl", [{"symbols": []}, info])


def test_reader_takes_all_codecs_and_drops_broken_lines(spark, tmp_path):
    lay_out(str(tmp_path))
    rows = raw.read_channel(spark, str(tmp_path), "trade_v2", venue=SPOT, date=DAY)
    assert rows.count() == 4
    depth = raw.read_channel(spark, str(tmp_path), "depth_v2", date=DAY).orderBy("session_seq").select("first_id", "final_id", "lastUpdateId").collect()
    assert depth == [Row(None, None, 101), Row(102, 102, None), Row(103, 103, None)]
    assert raw.read_channel(spark, str(tmp_path), "depth_v2", symbol="NONE").count() == 0


def test_ticks_in_committed_order(spark, tmp_path):
    lay_out(str(tmp_path))
    ticks = trades.to_ticks(raw.read_channel(spark, str(tmp_path), "trade_v2", venue=SPOT)).orderBy(*trades.ORDER).collect()
    assert [float(t.price) for t in ticks] == [100.0, 101.0, 102.0]
    assert [t.aggressor for t in ticks] == ["BUYER", "SELLER", "BUYER"] and {t.trade_id for t in ticks} == {"12345"}


def test_exchange_info_and_trading_symbols(spark, tmp_path):
    lay_out(str(tmp_path))
    info = raw.exchange_info(spark, str(tmp_path), SPOT)
    assert info.count() == 2
    assert [r.symbol for r in raw.trading_symbols(info, spot=True).collect()] == ["BTCUSDT"]


def test_convert_twice_gives_the_same_rows(spark, tmp_path):
    root, out = str(tmp_path / "raw"), str(tmp_path / "catalog")
    lay_out(root)
    for _ in range(2):
        report = convert.convert_date(spark, root, str(tmp_path / "meta"), out, DAY, interval_s=0)
    assert report["status"] == "ok" and report["totals"] == {"ticks_written": 3, "events": 3, "depth10s": 3}
    counts = {(r.kind, r.instrument_id): r.n for r in catalog.inspect(spark, out).collect()}
    assert counts == {("trade_ticks", "BTCUSDT.BINANCE"): 3, ("deltas", "BTCUSDT.BINANCE"): 3, ("depth10", "BTCUSDT.BINANCE"): 3}
    assert convert.validate_report(report) == []
    assert catalog.purge(spark, out, ["BTCUSDT.BINANCE"], DAY) == 3
    assert catalog.inspect(spark, out).count() == 0


def test_no_data_and_refusal(spark, tmp_path):
    assert convert.convert_date(spark, str(tmp_path), str(tmp_path), str(tmp_path / "c"), DAY)["status"] == "no_data"
    expected = spark.createDataFrame([(SPOT, f"S{i}") for i in range(50)], "venue string, symbol string")
    assert quality.overwrite_guard(expected, expected.limit(39)).first().refused
    assert not quality.overwrite_guard(expected, expected.limit(40)).first().refused
    assert not quality.overwrite_guard(expected, expected.limit(1), staging=True).first().refused


def test_staging_swaps_the_catalog(spark, tmp_path):
    root, out = str(tmp_path / "raw"), str(tmp_path / "catalog")
    lay_out(root)
    report = convert.convert_date(spark, root, str(tmp_path / "meta"), out, DAY, staging=True)
    assert report["status"] == "ok" and os.path.isdir(out) and sorted(os.listdir(tmp_path)) == ["catalog", "raw"]


def test_nothing_is_left_of_refused_and_empty_runs(spark, tmp_path):
    root, out = str(tmp_path / "raw"), str(tmp_path / "catalog")
    put(root, SPOT, "trade_v2", "BTCUSDT", "00.jsonl", [{"record_type": "trade_stream_lifecycle", "ts_recv_ns": 1}])
    assert convert.convert_date(spark, root, str(tmp_path / "meta"), out, DAY, staging=True)["status"] == "empty"
    assert sorted(os.listdir(tmp_path)) == ["raw"]
    os.makedirs(tmp_path / "meta" / "universe" / SPOT)
    (tmp_path / "meta" / "universe" / SPOT / f"{DAY}.json").write_text(json.dumps([f"S{i}" for i in range(60)]))
    assert convert.convert_date(spark, root, str(tmp_path / "meta"), out, DAY)["status"] == "refused_partial_raw_depth"
    assert sorted(os.listdir(tmp_path)) == ["meta", "raw"]


def test_a_second_run_without_trades_leaves_none(spark, tmp_path):
    root, out = str(tmp_path / "raw"), str(tmp_path / "catalog")
    lay_out(root)
    convert.convert_date(spark, root, str(tmp_path / "meta"), out, DAY)
    shutil.rmtree(os.path.join(root, SPOT, "trade_v2"))
    report = convert.convert_date(spark, root, str(tmp_path / "meta"), out, DAY)
    assert report["totals"]["ticks_written"] == 0
    assert {r.kind for r in catalog.inspect(spark, out).collect()} == {"deltas", "depth10"}


def test_numbers_that_the_catalog_does_not_hold_are_bad(spark, tmp_path):
    root, out = str(tmp_path / "raw"), str(tmp_path / "catalog")
    bids = ["Infinity", "1_000", "NaN", "1e30", "abc", "7"]
    put(root, SPOT, "depth_v2", "BTCUSDT", "00.jsonl", [snapshot(1, 10)] + [update(2 + i, 11, payload={"bids": [["98", "1"], [b, "1"]], "asks": []}) for i, b in enumerate(bids)])
    report = convert.convert_date(spark, root, str(tmp_path / "meta"), out, DAY)
    depth = report["depth"][0]
    assert depth["bad"] == 5 and depth["deltas_written"] == 2 and depth["raw_record_count"] == 7 and depth["will_create_l2"] and depth["fenced_ranges"] == 0
    rows = catalog.read(spark, out, "deltas").where("action = 'UPDATE'").collect()
    assert sorted(float(r.price) for r in rows) == [7, 98, 99, 101]


def test_exchange_information_of_the_day_and_of_documents(spark, tmp_path):
    def info(*names, status="TRADING"):
        return {"symbols": [{"symbol": n, "status": status, "baseAsset": n[:-4], "quoteAsset": "USDT", "filters": []} for n in names]}

    root = str(tmp_path / "raw")
    put(root, FUTURES, "exchangeinfo", "ALL", "00.jsonl", [info("OLDUSDT")])
    put(root, FUTURES, "exchangeinfo", "ALL", "01.jsonl", [info(), info("NEWUSDT", "BUSDT"), info("NOUSDT")])
    put(root, FUTURES, "exchangeinfo", "ALL", "02.jsonl", [info()])
    os.makedirs(os.path.join(root, FUTURES, "exchangeinfo", "ALL", "2026-05-01"))
    with open(os.path.join(root, FUTURES, "exchangeinfo", "ALL", "2026-05-01", "00.jsonl"), "w") as f:
        f.write(json.dumps(info("LATERUSDT", status="BREAK")) + "\n")
    assert {r.symbol for r in raw.exchange_info(spark, root, FUTURES, DAY).collect()} == {"NEWUSDT", "BUSDT"}
    assert raw.exchange_info(spark, root, FUTURES, "2026-01-01").count() == 0
    assert {r.symbol for r in raw.trading_in_files(spark, root, FUTURES).collect()} == {"NEWUSDT", "BUSDT", "NOUSDT"}
    (tmp_path / "info.json").write_text(json.dumps(info("AUSDT", "CUSDT")))
    assert {(r.symbol, r.venue) for r in raw.exchange_info_document(spark, str(tmp_path / "info.json"), SPOT).collect()} == {("AUSDT", SPOT), ("CUSDT", SPOT)}
    (tmp_path / "t.json").write_text(json.dumps([{"symbol": "AUSDT", "quoteVolume": "5.5", "x": 1}, {"quoteVolume": "1"}, {"symbol": "CUSDT", "quoteVolume": "7"}]))
    tickers = raw.ticker_document(spark, str(tmp_path / "t.json"))
    assert [(r.symbol, r.ordinal) for r in universe.rank(tickers, 5).orderBy("rank").collect()] == [("CUSDT", 2), ("AUSDT", 0)]


def test_discovery_reads_all_channels_but_exchange_information(spark, tmp_path):
    put(str(tmp_path), SPOT, "other", "AUSDT", "00.jsonl", [{}])
    put(str(tmp_path), SPOT, "trade_v2", "BUSDT", "00.jsonl", [{}])
    put(str(tmp_path), SPOT, "exchangeinfo", "ALL", "00.jsonl", [{}])
    assert {r.symbol for r in raw.discover(spark, str(tmp_path), DAY).collect()} == {"AUSDT", "BUSDT"}
    expected = spark.createDataFrame([(SPOT, "CUSDT"), (SPOT, "BUSDT")], "venue string, symbol string")
    assert sorted(r.symbol for r in raw.with_trades(spark, str(tmp_path), DAY, expected).collect()) == ["BUSDT", "CUSDT"]


def test_rejects_name_their_stage_and_reason(spark):
    tickers = spark.createDataFrame([(s, str(90 - i), i) for i, s in enumerate(["1USDT", "AAUSDT", "BBUSDT", "CCUSDT"])], "symbol string, quoteVolume string, ordinal int")
    one = lambda s: tickers.where(F.col("symbol").isin(*s)).select("symbol")
    found = universe.select(tickers, 10, one(["1USDT", "BBUSDT", "CCUSDT"]), one(["BBUSDT", "AAUSDT"]), unsupported=universe.FUTURES_UNSUPPORTED).rejects.orderBy("rank").collect()
    assert [(r.symbol, r.stage) for r in found] == [("1USDT", "sanity"), ("AAUSDT", "support"), ("BBUSDT", "health")]
    assert [r.reason for r in found[1:]] == ["not found in futures exchangeInfo TRADING symbols", "temporarily_unhealthy_zero_messages"]


def test_report_is_saved_whole(spark, tmp_path):
    for _ in range(2):
        convert.save_report(spark, {"a": 1}, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"a": 1}
    assert [n for n in os.listdir(tmp_path) if not n.endswith(".crc")] == ["r.json"]


def test_universe_documents(spark, tmp_path):
    assert raw.universe_from_json(json.dumps({SPOT: ["A", "", None, "B"]}), SPOT) == ["A", "B"]
    assert raw.universe_from_json('["X"]', FUTURES) == ["X"] and raw.universe_from_json("{", SPOT) is None
    lay_out(str(tmp_path))
    os.makedirs(tmp_path / "universe" / SPOT)
    (tmp_path / "universe" / SPOT / f"{DAY}.json").write_text("{broken")
    assert raw.resolve_universe(spark, str(tmp_path), str(tmp_path), DAY) == {SPOT: ["BTCUSDT"], FUTURES: ["ETHUSDT"]}


def test_gaps(spark):
    at = lambda *s: spark.createDataFrame([(SPOT, "A", x * 10**9) for x in s], "venue string, symbol string, ts long")
    got = quality.gap_stats(at(0, 2, 8, 70)).first()
    assert (got.max_gap_ns, got.over_1s, got.over_5s, got.over_60s) == (62 * 10**9, 3, 2, 1)
    got = quality.gap_stats(at(3, 1, 2)).first()
    assert (got.max_gap_ns, got.over_1s) == (10**9, 0)


def test_severity(spark):
    rows = [("websocket_closed", False, "low"), ("continuity_break", False, "high"), ("continuity_break", True, "medium"), ("snapshot_failed:bootstrap", False, "low"), ("snapshot_failed", True, "high"), (None, True, "medium")]
    got = spark.createDataFrame(rows, "r string, ok boolean, want string").select("want", scalars.fence_severity(scalars.fence_reason(F.col("r")), F.col("ok")).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_selection_funnel(spark):
    names = ["BTCUSDT", "ETHUSDT", "1000PEPEUSDT", "FDUSDUSDT", "XUSDT", "123USDT", "ABCBTC"]
    rows = spark.createDataFrame([(s, str(1000 - i), i) for i, s in enumerate(names)], "symbol string, quoteVolume string, ordinal int")
    got = universe.select(rows, 120)
    assert [r.symbol for r in got.selected.orderBy("nth").collect()] == names[:4]
    funnel = got.funnel.first()
    assert (funnel.pool, funnel.after_sanity, funnel.support_available) == (6, 4, False)
    trading = spark.createDataFrame([("BTCUSDT",), ("FDUSDUSDT",)], "symbol string")
    sick = spark.createDataFrame([("BTCUSDT",)], "symbol string")
    got = universe.select(rows, 120, trading, sick, top=1)
    assert [r.symbol for r in got.selected.collect()] == ["FDUSDUSDT"] == [r.symbol for r in got.replacements.collect()]


def test_health_streak_counts_back_from_the_newest_day(spark):
    rows = [(SPOT, "UTK", f"2026-04-{d:02d}", 400.0, m, 0) for d, m in ((14, 0), (15, 5), (16, 0), (17, 0))]
    days = spark.createDataFrame(rows, "venue string, symbol string, date string, observation_sec double, depth_message_count long, trade_message_count long")
    got = universe.health_streaks(days, F.to_date(F.lit("2026-04-18"))).first()
    assert (got.zero_runs, got.streak_date, got.excluded) == (2, "2026-04-16", True)
    assert not universe.health_streaks(days, F.to_date(F.lit("2026-04-30"))).first().excluded


def test_actions_and_warnings(spark):
    stats = spark.createDataFrame([(FUTURES, "BTCUSDT", 5, 0), (FUTURES, "XUSDT", 0, 0)], "venue string, symbol string, depth_message_count long, trade_message_count long")
    got = {r.symbol: r.suggested_action for r in health.actions(stats, stats, 400.0).collect()}
    assert got == {"BTCUSDT": "keep", "XUSDT": "temporary_exclude_candidate"}
    assert {r.suggested_action for r in health.actions(stats, stats, 30.0).where("symbol = 'XUSDT'").collect()} == {"watch"}
    assert [r.symbol for r in health.zero_trade_warnings(stats, stats, stats, stats, 400.0).collect()] == ["BTCUSDT"]
    assert health.zero_trade_warnings(stats, stats, stats, stats, 30.0).count() == 0


def test_skip_reasons(spark):
    frames = [("{", "malformed_json"), ('{"x":1}', "missing_combined_data"), ('{"data":{"e":"trade","t":1}}', "missing_symbol"), ('{"data":{"e":"trade","s":"A"}}', "missing_spot_trade_id"),
              ('{"data":{"e":"aggTrade","s":"A"}}', "missing_futures_agg_trade_id"), ('{"data":{"e":"aggTrade","s":"A","a":1}}', "missing_futures_trade_id"), ('{"data":{"e":"trade","s":"A","t":1}}', None), (None, "malformed_json")]
    got = spark.createDataFrame(frames, "frame string, want string").select("want", trades.skip_reason(F.col("frame")).alias("got")).collect()
    assert [(r.want, r.got) for r in got if r.want != r.got] == []


def test_purge_only_files_of_the_day(spark):
    stamp = "T00-00-00-000000000Z"
    rows = [("A", f"2026-04-17{stamp}_2026-04-17{stamp}.parquet"), ("A", f"2026-04-18{stamp}_2026-04-18{stamp}.parquet"), ("B", f"2026-04-17{stamp}_2026-04-17{stamp}.parquet"), ("A", "part-0.parquet")]
    got = catalog.files_to_purge(spark.createDataFrame(rows, "instrument_id string, name string"), ["A"], DAY).collect()
    assert [r.name[:10] for r in got] == [DAY]


def test_unknown_symbols_get_default_instruments(spark):
    keys = spark.createDataFrame([(FUTURES, "NEWUSDT")], "venue string, symbol string")
    info = spark.createDataFrame([], "venue string, symbol string, baseAsset string, quoteAsset string, filters array<struct<filterType:string,tickSize:string,stepSize:string,minQty:string,minNotional:string>>")
    got = instruments.build(keys, info).first()
    assert (got.instrument_id, got.base, got.price_precision, got.price_increment, got.size_increment) == ("NEWUSDT-PERP.BINANCE", "NEW", 2, "0.01", "0.00001")


ARRIVALS = [
    ("connect", None, None, None, None), ("update", 99, 100, None, None), ("update", 101, 102, None, None), ("snapshot", None, None, None, 100), ("update", 103, 103, None, None),
    ("update", 110, 111, None, None), ("snapshot", None, None, None, 111), ("update", 112, 113, None, None),
]


def test_stream_equals_batch_and_promotes_buffer(spark, tmp_path):
    rows = [{"venue": SPOT, "symbol": s, "kind": k, "arrival": i, "first_id": a, "final_id": b, "pu": p, "last_update_id": last, "ts_recv_ns": i * 10**9} for s in ("A", "B") for i, (k, a, b, p, last) in enumerate(ARRIVALS)]
    source = tmp_path / "in"
    source.mkdir()
    for n, part in enumerate((rows[:3] + rows[8:12], rows[3:8] + rows[12:])):
        (source / f"{n}.json").write_text("\n".join(map(json.dumps, part)))
        os.utime(source / f"{n}.json", (1_000_000 + n, 1_000_000 + n))  # files are taken by age
    frame = spark.createDataFrame(rows, jobs.ARRIVALS)
    order = ["symbol", "session", "session_seq"]
    batch = sync.synchronise_batch(frame).orderBy(*order).collect()
    updates = [(r.session_seq, r.final_id) for r in batch if r.symbol == "A" and r.record_type == "depth_update"]
    assert [u for _, u in updates] == [102, 103, 113]
    assert [r.state for r in batch if r.symbol == "A" and r.record_type == "sync_state"] == ["unsynced", "resync_required", "snapshot_seeded", "live_synced", "desynced", "resync_required", "snapshot_seeded", "live_synced"]
    arrivals = jobs.file_source(spark, str(source), files_per_trigger=1)
    jobs.commit_log(sync.synchronise(arrivals), str(tmp_path / "out"), str(tmp_path / "state"), once=True).awaitTermination(120)
    streamed = spark.read.json(str(tmp_path / "out"))
    assert streamed.count() == len(batch)
    got = streamed.where("record_type = 'depth_update'").orderBy(*order).select("symbol", "session_seq", "final_id").collect()
    assert [tuple(r) for r in got] == [(r.symbol, r.session_seq, r.final_id) for r in batch if r.record_type == "depth_update"]


def test_heartbeat_document(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps({"venue": SPOT, "symbol": s, "channel": "depth_v2", "ts_ns": 5, "id": 1}) for s in ("A", "B")))
    messages = spark.readStream.schema("venue string, symbol string, channel string, ts_ns long, id long").json(str(tmp_path / "in"))
    requested = spark.createDataFrame([(SPOT, s) for s in "ABCDE"], "venue string, symbol string")
    jobs.heartbeat(messages, str(tmp_path / "beat.json"), str(tmp_path / "c"), requested, once=True).awaitTermination(120)
    assert json.loads((tmp_path / "beat.json").read_text())["coverage"][0]["ratio"] == 0.4


def test_universe_document_is_used_again_only_under_its_policy(spark, tmp_path):
    names = ["BTCUSDT", "ETHUSDT", "SOLUSDT"]
    rows = spark.createDataFrame([(n, str(100 - i), i) for i, n in enumerate(names)], "symbol string, quoteVolume string, ordinal int")
    both = {SPOT: rows, FUTURES: rows}
    sick = {SPOT: rows.where("symbol = 'ETHUSDT'")}
    doc = universe_cache.document(both, both, sick, "2026-04-17T00:00:00", top=2)
    assert doc[SPOT] == ["BTCUSDT", "SOLUSDT"] and doc[FUTURES] == names[:2]
    assert doc["selection_metadata"][SPOT]["replacement_symbols"] == ["SOLUSDT"]
    assert universe_cache.usable(doc, top=2) and not universe_cache.usable(doc) and not universe_cache.usable([])
    assert not universe_cache.usable(doc | {SPOT: ["BTCUSDT"]}, top=2)
    universe_cache.save(spark, doc, str(tmp_path), DAY)
    assert raw.resolve_universe(spark, str(tmp_path), str(tmp_path), DAY)[SPOT] == doc[SPOT]


def arrival(kind, n, seconds, **ids):
    return {"kind": kind, "arrival": n, "ts_recv_ns": int(seconds * 1e9), "first_id": None, "final_id": None, "pu": None, "last_update_id": None} | ids


def test_requests_wait_for_the_cooldown():
    m = sync.Sync(SPOT, "A")
    m.take(arrival("connect", 0, 0))
    m.take(arrival("snapshot", 1, 1, last_update_id=10))
    m.take(arrival("update", 2, 2, first_id=11, final_id=11))
    m.take(arrival("update", 3, 3, first_id=20, final_id=20))
    assert m.s["state"] == "desynced" and m.s["bootstraps"] == 1 and m.s["asked"] == []
    m.take(arrival("update", 4, 4, first_id=21, final_id=21))
    assert m.s["state"] == "desynced"
    m.take(arrival("update", 5, 6, first_id=22, final_id=22))
    assert m.s["state"] == "resync_required" and len(m.s["asked"]) == 1 and len(m.s["buffer"]) == 3
    for i in range(7):
        m.take(arrival("snapshot", 10 * i + 10, 10 * i + 10, last_update_id=100 * i + 100))
        m.take(arrival("update", 10 * i + 11, 10 * i + 16, first_id=5, final_id=9000))
        m.take(arrival("update", 10 * i + 12, 10 * i + 17, first_id=99_000, final_id=99_001))
    assert m.s["state"] == "fenced" and m.s["bootstraps"] == 1


def test_large_ids_stay_exact(spark):
    big = 2**53 + 1
    rows = [(SPOT, "A", "connect", 0, None, None, None, None, 0), (SPOT, "A", "snapshot", 1, None, None, None, big, 1), (SPOT, "A", "update", 2, big + 1, big + 1, None, None, 2)]
    frame = spark.createDataFrame(rows, jobs.ARRIVALS)
    got = {r.record_type: r for r in sync.synchronise_batch(frame).collect()}
    assert got["snapshot_seed"].last_update_id == big and got["depth_update"].final_id == big + 1
