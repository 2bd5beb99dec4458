"""A session with the settings the jobs were designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Readings carry no zone; one zone for parsing, dates and keys.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Files of a useful size from the rebalance step before a write.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Split a hot partition of a join even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Do not record a Python call site per expression: it doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A late reading rewrites its own day, not the whole table.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "collarlake", **extra: str) -> SparkSession:
    """Get or create a session. ``extra`` holds further settings by full name."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
