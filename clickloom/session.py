"""Session settings the operators are written for."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Timestamps mean the same on every machine and in the comparison SQL.
    "spark.sql.session.timeZone": "UTC",
    # Partition counts, join strategies and skewed join partitions are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where the grouping after it then takes a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sort aggregates over a hot key merge on the map side before the shuffle; so do
    # session windows in streams.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # The JIT leaves a generated method above this size interpreted; Spark then splits it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(builder: SparkSession.Builder, **extra: str) -> SparkSession.Builder:
    """Apply the recommended settings, then the caller's own."""
    for key, value in (RECOMMENDED | extra).items():
        builder = builder.config(key, value)
    return builder


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, unless the path they start with already leads to it."""
    root = Path(__file__).resolve().parent.parent
    started_with = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    context = spark.sparkContext
    if root in (Path(p).resolve() for p in started_with) or any("clickloom" in f for f in context.listFiles):
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/clickloom", "zip", root, "clickloom")
    context.addPyFile(archive)  # Spark's own file server hands it to every executor
