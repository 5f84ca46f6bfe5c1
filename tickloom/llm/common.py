"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tickloom.session import ship

#: Rows in one Arrow batch handed to Python; keeps a batch of long texts small.
ARROW_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; only Spark's reader ever touches the path."""
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class _Scopes(threading.local):
    """Written tables by the scope that deletes them, innermost last."""

    def __init__(self):
        self.open: list[list[str]] = []


_scopes = _Scopes()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir or the context's checkpoint folder.

    Where neither is set it is one of our own: in the warehouse, which a cluster shares, or, if driver and executors
    are one process, a temporary folder.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if context._jsc.sc().getCheckpointDir().isEmpty():
            if context.master.startswith("local"):
                own = tempfile.mkdtemp(prefix="tickloom-")
                atexit.register(shutil.rmtree, own, ignore_errors=True)
            else:
                own = f"{spark.conf.get('spark.sql.warehouse.dir')}/_tickloom"
            context.setCheckpointDir(own)
        found = context._jsc.sc().getCheckpointDir().get()
    return found


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _at_exit(spark: SparkSession, path: str) -> None:
    """Delete a table that outlasts its operator when the driver ends, if the session still runs then."""

    def gone() -> None:
        if spark.sparkContext._jsc is not None:
            _delete(spark, [path])

    atexit.register(gone)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that materialize writes inside are deleted at the end; those of lasting belong to the scope outside."""
    _scopes.open.append([])
    try:
        yield
    finally:
        _delete(spark, _scopes.open.pop())


def _written(df: DataFrame, up: int) -> DataFrame:
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/tickloom-{uuid.uuid4().hex}"
    if len(_scopes.open) >= up:
        _scopes.open[-up].append(path)
    else:
        _at_exit(spark, path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back, which cuts its lineage."""
    return _written(df, 1)


def lasting(df: DataFrame) -> DataFrame:
    """materialize, for a table that is still read after the scope it is written in."""
    return _written(df, 2)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df does not use yet (names clash without regard to case)."""
    used = {c.lower() for c in df.columns}
    while wanted.lower() in used:
        wanted = f"_{wanted}"
    return wanted
