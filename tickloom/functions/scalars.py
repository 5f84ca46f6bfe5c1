"""Column expressions: times, prices, symbols, reasons, classes. All stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schemas import DECIMAL

MS = 1_000_000


def _set(c: Column) -> Column:
    """The value, or null where it is zero: `x or y` of the raw format treats both alike."""
    return F.nullif(c, F.lit(0))


def trade_event_ns(trade_ms: Column, event_ms: Column, recv_ns: Column) -> Column:
    """PRJ-02: trade time, else event time, else receive time; zero counts as missing."""
    return F.coalesce(_set(trade_ms) * MS, _set(event_ms) * MS, recv_ns, F.lit(0))


def coverage_event_ns(trade_ms: Column, event_ms: Column, recv_ns: Column) -> Column:
    """PRJ-03: the same chain, but zero is a time."""
    return F.coalesce(trade_ms * MS, event_ms * MS, recv_ns)


def depth_event_ns(event_ms: Column, exchange_ms: Column, recv_ns: Column) -> Column:
    """PRJ-04."""
    return F.coalesce(_set(event_ms) * MS, _set(exchange_ms) * MS, recv_ns, F.lit(0))


def gap_event_ns(trade_ms: Column, event_ms: Column, exchange_ms: Column, recv_ns: Column) -> Column:
    """PRJ-05: zero falls through up to the last millisecond field, which may be zero."""
    return F.coalesce(F.coalesce(_set(trade_ms), _set(event_ms), exchange_ms) * MS, recv_ns)


def aggressor(is_buyer_maker: Column) -> Column:
    """PRJ-06."""
    return F.when(F.coalesce(is_buyer_maker, F.lit(False)), "SELLER").otherwise("BUYER")


def trade_id(exchange_id: Column) -> Column:
    """PRJ-07."""
    return F.coalesce(_set(exchange_id).cast("string"), F.lit("0"))


def number(text: Column) -> Column:
    """PRJ-08: exact decimal, or null where the text is not one."""
    return text.try_cast(DECIMAL)


def safe_float(text: Column) -> Column:
    """PRJ-17: bad values are 0."""
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def instrument_id(venue: Column, symbol: Column) -> Column:
    """PRJ-09."""
    return F.concat(symbol, F.when(venue.contains("USDTF"), "-PERP").otherwise(""), F.lit(".BINANCE"))


def perpetual_name(symbol: Column) -> Column:
    """PRJ-22: BTCUSDT to BTC-USDT-PERP."""
    return F.when(symbol.endswith("USDT"), F.concat(F.substring(symbol, 1, F.length(symbol) - 4), F.lit("-USDT-PERP"))).otherwise(symbol)


def precision(text: Column) -> Column:
    """PRJ-10: decimals of a number's text without trailing zeros."""
    return F.when(F.instr(text, ".") > 0, F.length(F.rtrim(F.split_part(text, F.lit("."), F.lit(2)), F.lit("0")))).otherwise(0)


def filter_value(filters: Column, kind: str, field: str) -> Column:
    """PRJ-11: a field of the first filter of this kind."""
    return F.get(F.filter(filters, lambda f: f["filterType"] == kind), F.lit(0))[field]


def sanity_reason(symbol: Column, quote: str = "USDT") -> Column:
    """PRJ-15: why a symbol is unreasonable, by the first rule that it breaks; `ok` if it is fine."""
    base = F.substring(symbol, F.lit(1), F.length(symbol) - len(quote))
    return (
        F.when(symbol.isNull() | (symbol == ""), "symbol missing or not a string")
        .when(~symbol.endswith(quote), f"must end with {quote}")
        .when(symbol.rlike(r"[^\x00-\x7F]"), "contains non-ASCII characters")
        .when(~symbol.rlike(r"^[A-Z0-9]+USDT\z"), "fails conservative regex ^[A-Z0-9]+USDT$")
        .when(F.length(base) < 2, F.concat(F.lit("base asset shorter than 2 chars ('"), base, F.lit("')")))
        .when(base.rlike(r"^[0-9]+\z"), "base asset is digits only")
        .otherwise("ok")
    )


def symbol_warnings(symbol: Column, quote: str = "USDT") -> Column:
    """PRJ-16: everything that looks odd about a symbol, joined by `; `; empty if nothing does."""
    base = F.substring(symbol, F.lit(1), F.length(symbol) - len(quote))
    shaped = symbol.endswith(quote) & (F.length(symbol) > len(quote))
    found = F.array(
        F.when(symbol.rlike(r"[^\x00-\x7F]"), F.lit("contains non-ASCII characters")),
        F.when(shaped & (F.length(base) < 2), F.concat(F.lit("base asset shorter than 2 chars ('"), base, F.lit("')"))),
        F.when(shaped & base.rlike(r"^[\x00-\x7F]*\z") & base.rlike(r"[^A-Za-z0-9]"), F.lit("unexpected base asset characters")),
        F.when(~shaped, F.lit(f"unexpected symbol structure for quote {quote}")),
    )
    return F.array_join(F.array_compact(found), "; ")


#: Fixed values, in the order in which they are tried: part of a raw reason and its normalised name.
REASONS = (
    ("bootstrap", "bootstrap"),
    ("websocket_closed", "websocket_closed"),
    ("shutdown", "shutdown"),
    ("continuity", "continuity_break"),
    ("desync", "desynced"),
    ("snapshot", "no_snapshot_seed"),
    ("rate", "rate_limit_resync"),
    ("resync_limit", "rate_limit_resync"),
)


def fence_reason(reason: Column) -> Column:
    """PRJ-18: the first rule that matches names the reason."""
    text, found = F.lower(F.coalesce(reason, F.lit(""))), F.lit("unknown")
    for part, name in reversed(REASONS):
        found = F.when(text.contains(part), name).otherwise(found)
    return found


def fence_severity(reason: Column, recovered: Column) -> Column:
    """PRJ-19, of a normalised reason: planned stops are low, a missing snapshot and all that never recovered high."""
    planned = reason.isin("bootstrap", "shutdown") | ((reason == "websocket_closed") & ~recovered)
    return F.when(planned, "low").when((reason == "no_snapshot_seed") | ~recovered, "high").otherwise("medium")


def readiness(has_depth: Column, has_trades: Column) -> Column:
    """PRJ-20."""
    return F.when(has_depth & has_trades, "full_ready").when(has_depth, "l2_ready").when(has_trades, "trade_only").otherwise("not_ready")


def no_data_reason(depth: Column, trades: Column) -> Column:
    """PRJ-21, first half: null if both channels had messages."""
    return F.when((depth == 0) & (trades == 0), "zero_depth_and_trade_messages").when(depth == 0, "zero_depth_messages").when(trades == 0, "zero_trade_messages")


def suggested_action(depth: Column, trades: Column, observed_s: Column, least_s: float = 300.0) -> Column:
    """PRJ-21, second half: silence is only held against a symbol that was watched long enough."""
    silent = (depth == 0) & (trades == 0)
    return F.when(silent & (observed_s >= least_s), "temporary_exclude_candidate").when(depth == 0, "watch").otherwise("keep")


def report_time(ts: Column, zone: str = "Europe/Budapest") -> Column:
    """PRJ-23: local ISO time with its offset; ts is a UTC timestamp."""
    local = F.from_utc_timestamp(ts, zone)
    minutes = ((F.unix_micros(local) - F.unix_micros(ts)) / 60_000_000).cast("int")
    sign = F.when(minutes < 0, "-").otherwise("+")
    offset = F.concat(sign, F.lpad(F.floor(F.abs(minutes) / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0"))
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), offset)


def applied_levels(requested: Column, most: int = 10) -> Column:
    """PRJ-26: 0 and less mean the most there are."""
    kept = F.least(F.greatest(requested, F.lit(0)), F.lit(most))
    return F.when(kept == 0, most).otherwise(kept)
