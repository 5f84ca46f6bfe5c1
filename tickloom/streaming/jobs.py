"""Streaming jobs: replayed sources, the committed log, and heartbeats."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators import health
from tickloom.sources import raw

ARRIVALS = T.StructType([T.StructField(n, t) for n, t in (("venue", T.StringType()), ("symbol", T.StringType()), ("kind", T.StringType()), *((c, T.LongType()) for c in ("arrival", "first_id", "final_id", "pu", "last_update_id", "ts_recv_ns")))])


def file_source(spark: SparkSession, path: str, schema: T.StructType = ARRIVALS, files_per_trigger: int = 100) -> DataFrame:
    """SRC-12 offline: JSON lines that appear in a folder; the rate is bounded and nothing is ever dropped (STR-05)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def commit_log(records: DataFrame, path: str, checkpoint: str, once: bool = False, codec: str = "gzip") -> StreamingQuery:
    """SNK-01..03: committed records as JSON lines by venue and symbol and by UTC date and hour of receipt.

    codec zstd needs Hadoop's native library on the executors; the readers take either.
    """
    at = F.timestamp_micros(F.expr("ts_recv_ns div 1000"))
    rows = records.withColumns({"dt": F.date_format(at, "yyyy-MM-dd"), "hour": F.date_format(at, "HH")})
    writer = rows.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).option("compression", codec).partitionBy("venue", "symbol", "dt", "hour").outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()


def heartbeat(messages: DataFrame, path: str, checkpoint: str, requested: DataFrame, once: bool = False) -> StreamingQuery:
    """SNK-11: running message counts; every trigger writes one document with coverage per venue."""

    def write(batch: DataFrame, epoch: int) -> None:
        rows = [r.asDict() for r in health.coverage_ratio(batch.join(requested, ["venue", "symbol"], "left_semi"), requested).collect()]
        raw.save_text(batch.sparkSession, path, json.dumps({"epoch": epoch, "at": int(time.time()), "coverage": rows}))

    writer = health.message_stats(messages).writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def windowed_counts(messages: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """STR-08, an addition: messages per event-time window, late ones up to the watermark."""
    at = F.timestamp_micros(F.expr("ts_ns div 1000")).alias("at")
    rows = messages.select("venue", "symbol", "channel", at).withWatermark("at", late)
    return rows.groupBy(F.window("at", width), "venue", "channel").agg(F.count(F.lit(1)).alias("n"))
