"""Instruments out of exchange information, and their join with records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import scalars

# What a missing filter stands for.
DEFAULTS = {"tick_size": "0.01000000", "step_size": "0.00001000", "min_qty": "0.00001000", "min_notional": "5.00000000"}
FIELDS = {"tick_size": ("PRICE_FILTER", "tickSize"), "step_size": ("LOT_SIZE", "stepSize"), "min_qty": ("LOT_SIZE", "minQty"), "min_notional": ("NOTIONAL", "minNotional")}


def build(universe: DataFrame, info: DataFrame) -> DataFrame:
    """JOI-02 and PRJ-09..12: one row for each (venue, symbol) of the universe; unknown symbols get DEFAULTS.

    Increments are written with the decimals of tick and step. A symbol with a bad number is left out.
    """
    rows = universe.select("venue", "symbol").distinct().join(info.select("venue", "symbol", "baseAsset", "quoteAsset", "filters"), ["venue", "symbol"], "left")
    for name, (kind, field) in FIELDS.items():
        rows = rows.withColumn(name, F.coalesce(scalars.filter_value(F.col("filters"), kind, field), F.lit(DEFAULTS[name])))
    rows = rows.withColumns({"price_precision": scalars.precision(F.col("tick_size")), "size_precision": scalars.precision(F.col("step_size"))})
    bad = None
    for name in FIELDS:
        wrong = F.col(name).try_cast("decimal(38,18)").isNull()
        bad = wrong if bad is None else bad | wrong
    # trailing zeros go, down to the decimals of the tick or step
    shown = lambda name, digits: F.format_string("%s", F.expr(f"format_number(cast({name} as decimal(38,18)), concat('0', if({digits} > 0, concat('.', repeat('0', {digits})), '')))"))
    rows = rows.where(~bad)
    return rows.select(
        "venue",
        "symbol",
        scalars.instrument_id(F.col("venue"), F.col("symbol")).alias("instrument_id"),
        F.coalesce("baseAsset", F.replace("symbol", F.lit("USDT"), F.lit(""))).alias("base"),
        F.coalesce("quoteAsset", F.lit("USDT")).alias("quote"),
        "price_precision",
        "size_precision",
        shown("tick_size", "price_precision").alias("price_increment"),
        shown("step_size", "size_precision").alias("size_increment"),
        shown("min_qty", "size_precision").alias("min_quantity"),
        F.col("min_notional").try_cast("double").alias("min_notional"),
        F.col("venue").contains("USDTF").alias("perpetual"),
    )


def attach(records: DataFrame, instruments: DataFrame, keep: tuple[str, ...] = ("instrument_id",)) -> DataFrame:
    """JOI-01: records of known instruments. Spark broadcasts the instruments where their size allows."""
    return records.join(instruments.select("venue", "symbol", *keep), ["venue", "symbol"])


def unknown(records: DataFrame, instruments: DataFrame) -> DataFrame:
    """The symbols that attach() leaves out."""
    return records.select("venue", "symbol").distinct().join(instruments, ["venue", "symbol"], "left_anti")
