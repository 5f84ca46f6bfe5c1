"""Fixed schemas of the raw channels and the names that occur in them."""

from __future__ import annotations

from pyspark.sql import types as T

# Names that the raw data and the reports use.
SPOT, FUTURES = "BINANCE_SPOT", "BINANCE_USDTF"
VENUES = (SPOT, FUTURES)
CHANNELS = ("depth_v2", "trade_v2", "exchangeinfo")
F_LAST, F_SNAPSHOT = 128, 32
NANOS = 1_000_000_000

DECIMAL = "decimal(38,18)"


def _schema(fields: str) -> T.StructType:
    """A StructType from `name type` pairs; types are the few simple names used here."""
    simple = {"int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType()}
    levels = T.ArrayType(T.ArrayType(T.StringType()))
    simple["levels"] = T.StructType([T.StructField("bids", levels), T.StructField("asks", levels)])
    return T.StructType([T.StructField(name, simple[kind]) for name, kind in (f.split() for f in fields.split(","))])


DEPTH = _schema(
    "schema_version int,record_type string,venue string,symbol string,channel string,stream_session_id bigint,session_seq bigint,"
    "connection_seq bigint,ts_recv_ns bigint,ts_event_ms bigint,exchange_ts_ms bigint,U bigint,u bigint,pu bigint,lastUpdateId bigint,"
    "sync_state string,sync_reason string,previous_state string,state string,event string,reason string,last_update_id bigint,"
    "prev_update_id bigint,payload levels,_corrupt string"
)
TRADE = _schema(
    "schema_version int,record_type string,venue string,market_type string,symbol string,channel string,trade_stream_session_id bigint,"
    "trade_session_seq bigint,ts_recv_ns bigint,ts_event_ms bigint,ts_trade_ms bigint,price string,quantity string,is_buyer_maker boolean,"
    "exchange_trade_id bigint,best_match_flag boolean,buyer_order_id bigint,seller_order_id bigint,first_trade_id bigint,"
    "last_trade_id bigint,event string,reason string,native_payload string,_corrupt string"
)
EXCHANGE_INFO = T.StructType(
    [
        T.StructField("venue", T.StringType()),
        T.StructField("ts_recv_ns", T.LongType()),
        T.StructField(
            "symbols",
            T.ArrayType(
                T.StructType(
                    [T.StructField(n, T.StringType()) for n in ("symbol", "status", "baseAsset", "quoteAsset")]
                    + [T.StructField("isSpotTradingAllowed", T.BooleanType()), T.StructField("permissions", T.ArrayType(T.StringType())), T.StructField("permissionSets", T.ArrayType(T.ArrayType(T.StringType())))]
                    + [T.StructField("filters", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("filterType", "tickSize", "stepSize", "minQty", "minNotional")])))]
                )
            ),
        ),
        T.StructField("_corrupt", T.StringType()),
    ]
)
