"""Golden cases of the replay: sequences, seeds, desyncs and fences."""

from __future__ import annotations

import itertools

import pytest

from tickloom.operators import replay
from tickloom.schemas import FUTURES, SPOT


def rec(kind, seq, ids=None, session=1, venue=SPOT, pu=None, last=None, state=None, reason=None, bids=(("100", "1"),), asks=(("101", "1"),), ts=None):
    first, final = ids or (None, None)
    levels = lambda x: [list(p) for p in x]
    ts = seq * 1_000_000_000 if ts is None else ts
    return (venue, "BTCUSDT", session, seq, "f", seq, kind, state, reason, first, final, pu, last, levels(bids), levels(asks), ts, ts)


SCHEMA = (
    "venue string, symbol string, session long, seq long, file string, ordinal long, record_type string, state string, reason string, first_id long, "
    "final_id long, pu long, last_update_id long, bids array<array<string>>, asks array<array<string>>, ts_event long, ts_init long"
)


def run(spark, rows, **more):
    out = replay.replay(spark.createDataFrame(rows, SCHEMA), ["accepted", "delta", "depth10", "fence", "metrics"], **more).collect()
    kinds = lambda k: [r for r in out if r.kind == k]
    events = sorted({(r.event, r.sequence) for r in kinds("delta")})
    return {"sequences": [s for _, s in events], "fences": kinds("fence"), "depth10": kinds("depth10"), "deltas": kinds("delta"), "counts": kinds("metrics")[0].counts}


seed = lambda seq, last, **k: rec("snapshot_seed", seq, last=last, **k)
upd = lambda seq, first, final, **k: rec("depth_update", seq, (first, final), **k)


def test_spot_in_any_disk_order(spark):
    rows = [seed(1, 100), upd(2, 101, 102), upd(3, 103, 103)]
    for order in itertools.permutations(rows):
        assert run(spark, list(order))["sequences"] == [100, 102, 103]


def test_futures_fence_and_recovery(spark):
    f = {"venue": FUTURES}
    rows = [seed(1, 200, **f), upd(2, 198, 202, pu=199, **f), rec("sync_state", 3, state="desynced", reason="gap", **f), upd(4, 300, 301, pu=999, **f), seed(5, 204, **f), upd(6, 202, 206, pu=203, **f)]
    got = run(spark, rows, interval_s=0)
    assert len(got["sequences"]) == 4 and got["counts"]["seeds"] == 2 and got["counts"]["desyncs"] == 2
    assert [x.recovered for x in got["fences"]] == [True] and len(got["depth10"]) >= 2


def test_sessions_reset_and_close_fences(spark):
    rows = [upd(1, 5, 6), seed(1, 100, session=2), upd(2, 101, 101, session=2), seed(1, 50, session=3), upd(2, 51, 51, session=3)]
    got = run(spark, rows)
    assert len(got["sequences"]) == 4 and got["counts"]["seeds"] == 2
    assert [(x.reason, x.recovered) for x in got["fences"]] == [("no_snapshot_seed", False)]


def test_chain_mends_without_snapshot(spark):
    got = run(spark, [seed(1, 10), upd(2, 15, 16), upd(3, 11, 12)])
    assert got["sequences"] == [10, 12] and [x.recovered for x in got["fences"]] == [True]


@pytest.mark.parametrize(
    ("futures", "boot", "last", "first", "final", "pu", "fits"),
    [(True, True, 200, 195, 210, None, True), (True, True, 200, 205, 210, None, False), (True, True, 200, 195, 200, None, True), (True, True, 200, 190, 195, None, False),
     (True, False, 210, 0, 0, 210, True), (True, False, 210, 0, 0, 999, False), (False, True, 100, 101, 103, None, True), (False, True, 100, 95, 100, None, False), (False, False, None, 1, 2, None, False)],
)
def test_acceptance(futures, boot, last, first, final, pu, fits):
    assert replay.follows(futures, boot, last, first, final, pu) is fits


def test_levels_flags_and_padding(spark):
    rows = [seed(1, 10, bids=[("100.0", "1"), ("99", "2")], asks=[("101", "3")]), upd(2, 11, 11, bids=[("100.00", "0"), ("98", "4")], asks=[])]
    got = run(spark, rows, interval_s=0)
    snapshot = [(d.action, d.flags) for d in got["deltas"] if d.sequence == 10]
    assert snapshot == [("CLEAR", 32), ("UPDATE", 32), ("UPDATE", 32), ("UPDATE", 160)]
    assert [(d.action, d.flags) for d in got["deltas"] if d.sequence == 11] == [("DELETE", 0), ("UPDATE", 128)]
    last = got["depth10"][-1]
    assert [x[0] for x in last.bids[:3]] == ["99", "98", "0"] and len(last.bids) == len(last.asks) == 10


def test_one_sided_book_and_empty_snapshot(spark):
    assert run(spark, [seed(1, 10, asks=[])])["depth10"] == []
    got = run(spark, [seed(1, 10, bids=[], asks=[])])
    assert got["sequences"] == [] and got["counts"]["seeds"] == 1


def test_throttle_keeps_distance(spark):
    rows = [seed(1, 0, ts=0)] + [upd(i + 1, i, i, ts=i * 400_000_000) for i in range(1, 8)]
    assert [d.ts_event for d in run(spark, rows, interval_s=1.0)["depth10"]] == [0, 1_200_000_000, 2_400_000_000]


def test_bad_record_counts_and_goes_on(spark):
    got = run(spark, [seed(1, 10), upd(2, 11, 11, bids=[("x", "1")]), upd(3, 11, 12)])
    assert got["counts"]["bad"] == 1 and got["sequences"] == [10, 12]
