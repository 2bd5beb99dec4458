"""Schemas of the raw files and of the two typed staging tables.

Fixed values: names, types and lengths are those of the files and tables to be read.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _text(name: str, max_length: int | None = None) -> StructField:
    return StructField(name, StringType(), True, {"max_length": max_length} if max_length else {})


# Raw collar files. The time stays text until silver parses it.
RAW_TELEMETRY = StructType(
    [
        StructField("collar_id", StringType(), False),
        StructField("cat_id", StringType(), False),
        StructField("reading_time", StringType(), False),
        StructField("heart_rate_bpm", IntegerType()),
        StructField("activity_level", StringType()),
        StructField("steps_count", IntegerType()),
        StructField("purr_frequency_hz", DoubleType()),
        StructField("ambient_temp_c", DoubleType()),
        StructField("battery_level_pct", IntegerType()),
    ]
)

# Bronze: the raw columns and two audit columns.
BRONZE = StructType(
    RAW_TELEMETRY.fields
    + [StructField("ingested_at", TimestampType()), StructField("source_file", StringType())]
)

# Folders of bronze: the day of a file's readings and, in it, the batch that wrote the file.
BATCH = "ingest_batch"
RAW_DAY = "reading_day"
BRONZE_FILES = StructType(
    BRONZE.fields + [StructField(RAW_DAY, DateType()), StructField(BATCH, LongType())]
)

# Lines that could not be read, or not all of them, and what was wrong with each.
QUARANTINE = StructType(
    [
        StructField("line", StringType()),
        StructField("reason", StringType()),
        StructField("bad_columns", ArrayType(StringType())),
        StructField("ingested_at", TimestampType()),
        StructField("source_file", StringType()),
        StructField(BATCH, LongType()),
    ]
)

# One row per ingested batch: the days of its readings and whether some have none, how many
# readings it had, and how many lines went to quarantine.
BATCH_LOG = StructType(
    [
        StructField("days", ArrayType(DateType())),
        StructField("undated", BooleanType()),
        StructField("n_rows", LongType()),
        StructField("n_quarantined", LongType()),
        StructField(BATCH, LongType()),
    ]
)

STAGING_TELEMETRY = StructType(
    [
        _text("collar_id", 50),
        _text("cat_id", 50),
        StructField("reading_time", TimestampType()),
        StructField("heart_rate_bpm", IntegerType()),
        _text("activity_level", 30),
        StructField("steps_count", IntegerType()),
        StructField("purr_frequency_hz", DoubleType()),
        StructField("ambient_temp_c", DoubleType()),
        StructField("battery_level_pct", IntegerType()),
        StructField("ingested_at", TimestampType()),
        # Set by the load itself: a long path is no reason to reject a reading.
        _text("source_file"),
    ]
)

STAGING_REGISTRY = StructType(
    [
        _text("cat_id", 50),
        _text("name", 100),
        _text("breed", 100),
        _text("gender", 10),
        StructField("birth_date", DateType()),
        StructField("weight_lbs", DoubleType()),
        _text("owner_id", 50),
        StructField("registered_at", DateType()),
    ]
)


def all_text(schema: StructType) -> StructType:
    """The same columns, every one as text."""
    return StructType([StructField(name, StringType()) for name in schema.names])
