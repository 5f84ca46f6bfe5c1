"""Live depth synchronisation as a stateful stream: buffer, snapshot, promotion, continuity, resync budget.

One state per symbol, keyed by Structured Streaming: checkpoints make it survive restarts, and a batch read of the
same arrivals gives the same committed records.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickloom.operators.replay import follows
from tickloom.schemas import FUTURES
from tickloom.session import ship

# Bounds of the live synchronisation.
BUFFER, WINDOW_S, MOST_RESYNCS, COOLDOWN_S = 5000, 300, 6, 5

OUT = "venue string, symbol string, session long, session_seq long, arrival long, record_type string, state string, previous string, reason string, first_id long, final_id long, pu long, last_update_id long, ts_recv_ns long"


class Sync:
    """One symbol's machine. Arrivals are dicts with kind (connect, update, snapshot), ids, arrival, ts_recv_ns."""

    def __init__(self, venue: str, symbol: str, saved: str | None = None):
        self.venue, self.symbol = venue, symbol
        self.s: dict = json.loads(saved) if saved else {"session": 0, "seq": 0, "state": "unsynced", "last": None, "buffer": [], "asked": [], "requested": None, "bootstraps": 0}
        self.out: list[dict] = []

    def saved(self) -> str:
        return json.dumps(self.s)

    def commit(self, record_type: str, a: dict, **more: object) -> None:
        """STF-16: only what is committed gets a number."""
        self.s["seq"] += 1
        row = dict.fromkeys((c.split()[0] for c in OUT.split(", ")), None)
        ids = {k: a.get(k) for k in ("first_id", "final_id", "pu", "last_update_id")} if record_type in ("depth_update", "snapshot_seed") else {}
        self.out.append(row | {"venue": self.venue, "symbol": self.symbol, "session": self.s["session"], "session_seq": self.s["seq"], "arrival": a["arrival"], "record_type": record_type, "ts_recv_ns": a["ts_recv_ns"]} | ids | more)

    def become(self, state: str, reason: str, a: dict) -> None:
        """STF-18: every change of state is a committed row with the state before."""
        previous, self.s["state"] = self.s["state"], state
        self.commit("sync_state", a, state=state, previous=previous, reason=reason)

    def resync(self, reason: str, a: dict) -> None:
        """STF-17: too many requests within the window fence the symbol; bootstraps are counted on their own.

        A request within the cooldown of the one before is not made; the next arrival asks again.
        """
        now = a["ts_recv_ns"]
        if self.s["state"] == "fenced" or (self.s["requested"] is not None and now - self.s["requested"] < COOLDOWN_S * 1_000_000_000):
            return
        self.s["requested"] = now
        if reason == "bootstrap":
            self.s["bootstraps"] += 1
        else:
            self.s["asked"] = [t for t in self.s["asked"] if t >= now - WINDOW_S * 1_000_000_000] + [now]
            if len(self.s["asked"]) > MOST_RESYNCS:
                return self.become("fenced", f"resync_limit_exceeded:{reason}", a)
        return self.become("resync_required", reason, a)

    def take(self, a: dict) -> None:
        if a["kind"] == "connect":
            self.s |= {"session": self.s["session"] + 1, "seq": 0, "last": None, "buffer": []}
            self.commit("stream_lifecycle", a, reason="startup_or_reconnect")
            self.become("unsynced", "session_start", a)
            self.resync("bootstrap", a)
        elif a["kind"] == "snapshot":
            self.promote(a)
        elif self.s["last"] is None or self.s["state"] in ("desynced", "resync_required", "fenced"):
            self.s["buffer"] = (self.s["buffer"] + [a])[-BUFFER:]
            if self.s["state"] in ("unsynced", "desynced"):
                self.resync("bootstrap" if self.s["state"] == "unsynced" else "continuity_break", a)
        else:
            self.live(a)

    def promote(self, snapshot: dict) -> None:
        """STF-14: commit the snapshot and the buffered updates that continue it; stale ones are dropped.

        The first must overlap the snapshot and the rest must chain; a gap asks for another snapshot.
        """
        waiting = sorted(self.s["buffer"], key=lambda a: a["arrival"])
        self.s |= {"buffer": [], "last": snapshot["last_update_id"]}
        self.commit("snapshot_seed", snapshot)
        self.become("snapshot_seeded", "snapshot", snapshot)
        for i, a in enumerate(waiting):
            if self.stale(a):
                continue
            if not self.fits(a):
                self.s["buffer"] = waiting[i:]
                self.broken(a)
                return
            self.accept(a)

    def stale(self, a: dict) -> bool:
        futures, last = self.venue == FUTURES, self.s["last"]
        return self.s["state"] == "snapshot_seeded" and a["final_id"] is not None and (a["final_id"] < last if futures else a["final_id"] <= last)

    def fits(self, a: dict) -> bool:
        return follows(self.venue == FUTURES, self.s["state"] == "snapshot_seeded", self.s["last"], a["first_id"], a["final_id"], a["pu"])

    def accept(self, a: dict) -> None:
        self.commit("depth_update", a)
        self.s["last"] = a["final_id"]
        if self.s["state"] != "live_synced":
            self.become("live_synced", "first_update", a)

    def broken(self, a: dict) -> None:
        self.become("desynced", "continuity_break", a)
        self.resync("continuity_break", a)

    def live(self, a: dict) -> None:
        """STF-15: stale updates after a snapshot vanish, gaps break the chain."""
        if self.stale(a):
            return
        if self.fits(a):
            self.accept(a)
        else:
            self.s["buffer"] = [a]
            self.broken(a)


NUMBERS = ("arrival", "first_id", "final_id", "pu", "last_update_id", "ts_recv_ns")
NAMES = [c.split()[0] for c in OUT.split(", ")]
LONGS = {c.split()[0]: "Int64" for c in OUT.split(", ") if c.endswith(" long")}


def _exact(arrivals: DataFrame) -> DataFrame:
    """Numbers as text: pandas would turn a column of ids with gaps into doubles, which lose digits over 2**53."""
    return arrivals.select("venue", "symbol", "kind", *[F.col(c).cast("string").alias(c) for c in NUMBERS])


def _run(machine: Sync, batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
    rows = [r | {c: None if r[c] is None or r[c] != r[c] else int(r[c]) for c in NUMBERS} for batch in batches for r in batch.to_dict("records")]
    for row in sorted(rows, key=lambda r: r["arrival"]):
        machine.take(row)
    return pd.DataFrame(machine.out, columns=NAMES, dtype=object).astype(LONGS)


def synchronise(arrivals: DataFrame) -> DataFrame:
    """Committed records of a stream of arrivals (venue, symbol, kind, arrival, first_id, final_id, pu,
    last_update_id, ts_recv_ns), in append mode."""

    def step(key: tuple[str, str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        machine = Sync(*key, state.get[0] if state.exists else None)
        out = _run(machine, batches)
        state.update((machine.saved(),))
        yield out

    ship(arrivals.sparkSession)
    arrivals = _exact(arrivals)
    return arrivals.groupBy("venue", "symbol").applyInPandasWithState(step, OUT, "saved string", "append", GroupStateTimeout.NoTimeout)


def synchronise_batch(arrivals: DataFrame) -> DataFrame:
    """The same of a finished table, without state."""

    def step(key: tuple[str, str], rows: pd.DataFrame) -> pd.DataFrame:
        return _run(Sync(*key), iter([rows]))

    ship(arrivals.sparkSession)
    arrivals = _exact(arrivals)
    return arrivals.groupBy("venue", "symbol").applyInPandas(step, OUT)
