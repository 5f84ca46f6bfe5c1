"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per context: their Python finds it even if it is not installed there."""
    context = spark.sparkContext
    if getattr(context, "_tickloom_shipped", False):
        return
    here = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="tickloom-"), "tickloom.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, f"tickloom/{p.relative_to(here)}")
    context.addPyFile(target)
    context._tickloom_shipped = True


def session(master: str = "local[*]", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session with the settings that this library expects; cluster settings come from spark-submit."""
    return (
        SparkSession.builder.master(master)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
