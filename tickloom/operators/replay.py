"""Depth replay: an exact-decimal order book rebuilt from committed records, one ordered fold per symbol.

Whether an update is accepted depends on which ones before it were, so the fold is sequential within a symbol.
Records are dealt out by symbol, sorted within their partition and folded in a stream of Arrow batches: memory is
one book, not one day. `by_session` folds every session of a symbol on its own and closes the fence that a
session leaves open afterwards, which splits a very active symbol over many tasks.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.schemas import DECIMAL, F_LAST, F_SNAPSHOT, FUTURES
from tickloom.session import ship

KEYS = ["venue", "symbol"]
#: STF-01: the canonical order of one symbol's records.
ORDER = ["session", "seq", "file", "ordinal"]
IN = [*KEYS, *ORDER, "record_type", "state", "reason", "first_id", "final_id", "pu", "last_update_id", "bids", "asks", "ts_event", "ts_init"]
LEVELS = 10

OUT = pa.schema(
    [
        ("venue", pa.string()), ("symbol", pa.string()), ("kind", pa.string()), ("session", pa.int64()), ("seq", pa.int64()), ("event", pa.int64()),
        ("at", pa.int32()), ("action", pa.string()), ("side", pa.string()), ("price", pa.string()), ("size", pa.string()), ("flags", pa.int32()),
        ("sequence", pa.int64()), ("ts_event", pa.int64()), ("ts_init", pa.int64()),
        ("bids", pa.list_(pa.list_(pa.string()))), ("asks", pa.list_(pa.list_(pa.string()))),
        ("end_ts", pa.int64()), ("reason", pa.string()), ("trigger_id", pa.int64()), ("recovered", pa.bool_()), ("counts", pa.map_(pa.string(), pa.int64())),
    ]
)
OUT_SPARK = (
    "venue string, symbol string, kind string, session bigint, seq bigint, event bigint, at int, action string, side string, price string, size string, flags int, "
    "sequence bigint, ts_event bigint, ts_init bigint, bids array<array<string>>, asks array<array<string>>, "
    "end_ts bigint, reason string, trigger_id bigint, recovered boolean, counts map<string,bigint>"
)
COUNTED = {"depth_update": "updates", "snapshot_seed": "snapshots", "sync_state": "sync_rows", "stream_lifecycle": "lifecycle_rows"}


def prepared(records: DataFrame) -> DataFrame:
    """Raw depth records (as the reader gives them) in the narrow form that the fold takes."""
    ts = scalars.depth_event_ns(F.col("ts_event_ms"), F.col("exchange_ts_ms"), F.col("ts_recv_ns"))
    seq = F.coalesce("session_seq", "connection_seq", F.lit(0))
    return records.select(
        *KEYS, F.coalesce("stream_session_id", F.lit(0)).alias("session"), seq.alias("seq"), "file", "ordinal",
        F.coalesce("record_type", F.lit("depth_update")).alias("record_type"), "state", "reason", "first_id", "final_id", "pu",
        F.col("lastUpdateId").alias("last_update_id"), F.col("payload.bids").alias("bids"), F.col("payload.asks").alias("asks"),
        ts.alias("ts_event"), F.coalesce(F.nullif("ts_recv_ns", F.lit(0)), ts).alias("ts_init"),
    )


def from_frames(frames: DataFrame, frame: str = "frame") -> DataFrame:
    """PRJ-24: update fields out of WebSocket depth frames; frames without data or symbol are left out.

    Beside frames' columns come symbol, first_id, final_id, pu, ts_event_ms, bids, asks (empty where absent).
    """
    value = F.try_parse_json(F.col(frame))
    get = lambda k, kind: F.try_variant_get(value, f"$.data.{k}", kind)
    levels = lambda k: F.coalesce(get(k, "array<array<string>>"), F.array().cast("array<array<string>>"))
    rows = frames.where(F.coalesce(get("s", "string"), F.lit("")) != "")
    return rows.withColumns(
        {
            "record_type": F.lit("depth_update"), "symbol": get("s", "string"), "first_id": get("U", "bigint"), "final_id": get("u", "bigint"), "pu": get("pu", "bigint"),
            "ts_event_ms": get("E", "bigint"), "bids": levels("b"), "asks": levels("a"),
        }
    )


def follows(futures: bool, boot: bool, last: int | None, first: int | None, final: int | None, pu: int | None) -> bool:
    """STF-04: whether an update continues a book at id `last`."""
    if last is None or first is None or final is None:
        return False
    if futures:
        return first <= last <= final if boot else pu == last
    return first <= last + 1 <= final


#: What a number looks like, and the first that DECIMAL(38,18) does not hold.
NUMBER, TOO_LARGE = re.compile(r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"), Decimal(10) ** 20


def number(text: str) -> Decimal:
    """A price or size; ValueError where the catalog's type has no such number."""
    if not NUMBER.fullmatch(text):
        raise ValueError(text)
    value = Decimal(text)
    if abs(value) >= TOO_LARGE:
        raise ValueError(text)
    return value


#: A level as read: side, price, size, and both as they came.
Level = tuple[int, Decimal, Decimal, str, str]


def levels_of(r: dict) -> list[Level]:
    """The levels of a record, bids first; read before anything changes, so that a bad one changes nothing."""
    return [(side, number(p), number(s), p, s) for side, changes in enumerate((r["bids"], r["asks"])) for p, s in changes or ()]


class Book:
    """The state of one symbol and the rows it gives."""

    def __init__(self, venue: str, symbol: str, interval_ns: int, depth10: bool, wanted: frozenset[str]):
        self.key, self.futures = (venue, symbol), venue == FUTURES
        self.interval, self.depth10, self.wanted = interval_ns, depth10, wanted
        self.session: int | None = None
        self.state, self.last = "unsynced", None
        self.sides: tuple[dict[Decimal, Decimal], dict[Decimal, Decimal]] = ({}, {})
        #: The last book of the sessions before.
        self.kept = self.sides
        self.fence: dict | None = None
        self.emitted: int | None = None
        self.first_ts: int | None = None
        self.last_ts = 0
        self.counts = dict.fromkeys((*COUNTED.values(), "seeds", "resyncs", "desyncs", "events", "depth10s", "bad", "fences"), 0)
        self.rows: list[dict] = []

    def give(self, kind: str, **values: object) -> None:
        if kind in self.wanted:
            self.rows.append({"venue": self.key[0], "symbol": self.key[1], "kind": kind, "session": self.session, **values})

    def open_fence(self, reason: str, ts: int, trigger: int | None) -> None:
        if self.fence is None:
            self.fence = {"reason": reason, "ts_event": ts, "trigger_id": trigger, "session": self.session}

    def close_fence(self, ts: int, recovered: bool) -> None:
        if self.fence is not None:
            self.counts["fences"] += 1
            self.give("fence", **self.fence | {"end_ts": ts, "recovered": recovered})
            self.fence = None

    def apply(self, levels: list[Level]) -> None:
        for side, price, size, _, _ in levels:
            if size == 0:
                self.sides[side].pop(price, None)
            else:
                self.sides[side][price] = size

    def deltas(self, r: dict, levels: list[Level], sequence: int, snapshot: bool) -> None:
        """STF-08/09: one event of all levels of a message; a snapshot starts with a CLEAR."""
        if not levels:
            return
        self.counts["events"] += 1
        if "delta" not in self.wanted:
            return
        base = F_SNAPSHOT if snapshot else 0
        same = {"seq": r["seq"], "event": self.counts["events"], "sequence": sequence, "ts_event": r["ts_event"], "ts_init": r["ts_init"]}
        if snapshot:
            self.give("delta", at=0, action="CLEAR", flags=base, **same)
        for i, (side, _, value, price, size) in enumerate(levels):
            action = "UPDATE" if value > 0 else "DELETE"
            self.give("delta", at=i + snapshot, action=action, side=("BUY", "SELL")[side], price=price, size=size, flags=base | (F_LAST if i == len(levels) - 1 else 0), **same)

    def top(self, r: dict) -> None:
        """STF-10: the best ten levels of both sides, padded with zeros; nothing while a side is empty."""
        bids, asks = self.sides
        if not bids or not asks:
            return
        self.counts["depth10s"] += 1
        self.emitted = r["ts_event"]
        if "depth10" in self.wanted:
            best = [heapq.nlargest(LEVELS, bids.items()), heapq.nsmallest(LEVELS, asks.items())]
            b, a = ([[str(p), str(s)] for p, s in side] + [["0", "0"]] * (LEVELS - len(side)) for side in best)
            self.give("depth10", seq=r["seq"], sequence=self.last or 0, flags=0, ts_event=r["ts_event"], ts_init=r["ts_init"], bids=b, asks=a)

    def take(self, r: dict) -> None:
        kind, ts = r["record_type"], r["ts_event"]
        if kind in COUNTED:
            self.counts[COUNTED[kind]] += 1
        self.first_ts = ts if self.first_ts is None else self.first_ts
        self.last_ts = ts
        if r["session"] != self.session:
            if self.session is not None:
                self.close_fence(ts, False)
            if self.last is not None:
                self.kept = self.sides
            self.session, self.state, self.last, self.sides = r["session"], "unsynced", None, ({}, {})
        if kind == "sync_state":
            self.sync(r, ts)
        elif kind == "snapshot_seed":
            levels = levels_of(r)
            self.sides = ({}, {})
            self.apply(levels)
            self.last, self.state = r["last_update_id"], "snapshot_seeded"
            self.counts["seeds"] += 1
            self.close_fence(ts, True)
            self.deltas(r, levels, self.last, True)
            if self.depth10:
                self.top(r)
        elif kind == "depth_update":
            self.update(r, ts)

    def sync(self, r: dict, ts: int) -> None:
        self.state = r["state"]
        if self.state == "snapshot_seeded":
            self.close_fence(ts, True)
        elif self.state in ("resync_required", "desynced", "fenced"):
            if self.state != "fenced":
                self.counts["resyncs" if self.state == "resync_required" else "desyncs"] += 1
            self.open_fence(r["reason"] or self.state, ts, r["final_id"])

    def update(self, r: dict, ts: int) -> None:
        if self.last is None:
            self.open_fence("no_snapshot_seed", ts, r["final_id"])
        elif not follows(self.futures, self.state == "snapshot_seeded", self.last, r["first_id"], r["final_id"], r["pu"]):
            self.state = "desynced"
            self.counts["desyncs"] += 1
            self.open_fence("continuity_break", ts, r["final_id"])
        else:
            levels = levels_of(r)
            self.apply(levels)
            self.last, self.state = r["final_id"], "live_synced"
            self.give("accepted", seq=r["seq"], sequence=self.last, ts_event=ts, ts_init=r["ts_init"])
            self.deltas(r, levels, self.last, False)
            self.close_fence(ts, True)
            if self.depth10 and (self.emitted is None or self.interval <= 0 or ts - self.emitted >= self.interval):
                self.top(r)

    def end(self) -> None:
        self.close_fence(self.last_ts, False)
        if "book" in self.wanted:
            for side, levels in zip(("BUY", "SELL"), self.kept if self.last is None else self.sides):
                for price, size in sorted(levels.items()):
                    self.give("book", side=side, price=str(price), size=str(size), sequence=self.last, ts_event=self.last_ts)
        self.give("metrics", ts_event=self.first_ts, end_ts=self.last_ts, counts=list(self.counts.items()))


def replay(records: DataFrame, kinds: Iterable[str] = ("delta", "depth10", "fence", "metrics"), interval_s: float = 1.0, depth10: bool = True, by_session: bool = False) -> DataFrame:
    """STF-03: rows of the wanted kinds (accepted, delta, depth10, fence, metrics, book) in one table.

    records have the columns IN. A record whose levels or ids cannot be read counts as bad and the fold goes on.
    By session, the ten-level throttle starts anew in each session and metrics come per session.
    """
    wanted = frozenset(kinds)
    by = [*KEYS, "session"] if by_session else KEYS
    interval = round(interval_s * 1_000_000_000)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, key = None, None
        for batch in batches:
            done: list[dict] = []
            for r in batch.to_pylist():
                if (now := tuple(r[c] for c in by)) != key:
                    if book:
                        book.end()
                        done += book.rows
                    book, key = Book(r["venue"], r["symbol"], interval, depth10, wanted), now
                try:
                    book.take(r)
                except (ArithmeticError, TypeError, ValueError):
                    book.counts["bad"] += 1
                if len(book.rows) >= 5000:
                    done += book.rows
                    book.rows = []
                if len(done) >= 5000:
                    yield pa.RecordBatch.from_pylist(done, OUT)
                    done = []
            if book:
                done += book.rows
                book.rows = []
            if done:
                yield pa.RecordBatch.from_pylist(done, OUT)
        if book:
            book.end()
            if book.rows:
                yield pa.RecordBatch.from_pylist(book.rows, OUT)

    ship(records.sparkSession)
    dealt = records.select(*IN).repartition(*by).sortWithinPartitions(*KEYS, *ORDER)
    rows = dealt.mapInArrow(fold, OUT_SPARK)
    return _stitched(rows, records) if by_session and "fence" in wanted else rows


def _stitched(rows: DataFrame, records: DataFrame) -> DataFrame:
    """A fence that its session left open ends with the first record of the symbol's next session."""
    starts = records.groupBy(*KEYS, "session").agg(F.min_by("ts_event", F.struct("seq", "file", "ordinal")).alias("starts"))
    starts = starts.withColumn("next_ts", F.lead("starts").over(Window.partitionBy(*KEYS).orderBy("session"))).drop("starts")
    left_open = (F.col("kind") == "fence") & ~F.col("recovered")
    joined = rows.join(starts, [*KEYS, "session"], "left")
    return joined.withColumn("end_ts", F.when(left_open, F.coalesce("next_ts", "end_ts")).otherwise(F.col("end_ts"))).select(*rows.columns)


def deltas(rows: DataFrame) -> DataFrame:
    """Order book deltas with exact prices."""
    return rows.where("kind = 'delta'").select(*KEYS, "session", "seq", "event", "at", "action", "side", F.col("price").cast(DECIMAL).alias("price"), F.col("size").cast(DECIMAL).alias("size"), "flags", "sequence", "ts_event", "ts_init")


def depth10(rows: DataFrame) -> DataFrame:
    """Ten-level snapshots: prices and sizes of each side as arrays; counts are 1, padding included."""
    ones = F.array_repeat(F.lit(1), LEVELS)
    level = lambda side, i: F.transform(side, lambda x: x[i].cast(DECIMAL))
    return rows.where("kind = 'depth10'").select(
        *KEYS, "session", "seq", *[level(s, i).alias(f"{s[:3]}_{n}") for s in ("bids", "asks") for i, n in enumerate(("prices", "sizes"))],
        ones.alias("bid_counts"), ones.alias("ask_counts"), "flags", "sequence", "ts_event", "ts_init",
    )


def books(rows: DataFrame) -> DataFrame:
    """STF-05/06: levels of each symbol's book after the last record that changed it."""
    return rows.where("kind = 'book'").select(*KEYS, "session", "side", F.col("price").cast(DECIMAL).alias("price"), F.col("size").cast(DECIMAL).alias("size"), "sequence")


def fences(rows: DataFrame) -> DataFrame:
    reason = scalars.fence_reason(F.col("reason"))
    return rows.where("kind = 'fence'").select(*KEYS, "session", F.col("ts_event").alias("start_ts"), "end_ts", "reason", "trigger_id", "recovered", reason.alias("norm_reason"), scalars.fence_severity(reason, F.col("recovered")).alias("severity"))


def metrics(rows: DataFrame) -> DataFrame:
    names = [*COUNTED.values(), "seeds", "resyncs", "desyncs", "events", "depth10s", "bad", "fences"]
    return rows.where("kind = 'metrics'").select(*KEYS, F.col("ts_event").alias("first_ts"), F.col("end_ts").alias("last_ts"), *[F.col("counts")[n].alias(n) for n in names])


# What needs no fold: diagnostics by window functions, exact on tapes without chains that mend themselves.


def continuity(records: DataFrame) -> Column:
    """STF-04 as a window expression over a symbol's session: whether an update continues the one before."""
    w = Window.partitionBy(*KEYS, "session").orderBy("seq", "file", "ordinal")
    last = F.lag(F.coalesce("final_id", "last_update_id")).over(w)
    return F.when(F.col("venue") == FUTURES, F.col("pu") == last).otherwise((F.col("first_id") <= last + 1) & (last + 1 <= F.col("final_id")))


def best_levels(levels: DataFrame, n: int = LEVELS) -> DataFrame:
    """TOP-04: the best n levels of both sides, with their rank from 1."""
    best = Window.partitionBy(*KEYS, "side").orderBy(F.when(F.col("side") == "BUY", -F.col("price")).otherwise(F.col("price")))
    return levels.withColumn("level", F.row_number().over(best)).where(F.col("level") <= n)


def state_log(records: DataFrame) -> DataFrame:
    """STF-18: sync states with the state before, in canonical order."""
    w = Window.partitionBy(*KEYS).orderBy(*ORDER)
    return records.where("record_type = 'sync_state'").withColumn("previous", F.lag("state").over(w)).select(*KEYS, "session", "seq", "previous", "state", "reason")


def allocate_sequence(committed: DataFrame, arrival: str = "arrival") -> DataFrame:
    """STF-16: numbers of committed records, from 1 in each session of each symbol, in the order of arrival."""
    return committed.withColumn("session_seq", F.row_number().over(Window.partitionBy(*KEYS, "session").orderBy(arrival)).cast("long"))


def resync_budget(requests: DataFrame, seconds: int = 300, most: int = 6) -> DataFrame:
    """STF-17: requests (venue, symbol, at_s) with their number in the sliding window; fenced beyond `most`."""
    w = Window.partitionBy(*KEYS).orderBy("at_s").rangeBetween(-seconds, 0)
    rows = requests.withColumn("in_window", F.count(F.lit(1)).over(w))
    return rows.withColumn("fenced", F.col("in_window") > most)
