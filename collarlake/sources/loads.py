"""What a load has taken in: a manifest of files, bad files left out by name, a history.

A load compares the listing of the source with the manifest of earlier loads. A day whose
files are all known is not opened. A day with a new, changed or vanished file is loaded
whole and replaces what was loaded of it, so a load that stopped in between is made good by
the next one.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from collarlake.sources.tables import NO_DAY, PARTITION, day_folder, ensure, exists, files_in, on_days

# A file is known by its place, size and time of change.
FILE = StructType(
    [
        StructField("path", StringType()),
        StructField("size", LongType()),
        StructField("changed", TimestampType()),
    ]
)
# ``skipped`` says why a file was left out.
MANIFEST = StructType(
    [
        *FILE.fields,
        StructField("skipped", StringType()),
        StructField("load_id", LongType()),
        StructField(PARTITION, DateType()),
    ]
)
HISTORY = StructType(
    [
        StructField("load_id", LongType()),
        StructField("table_name", StringType()),
        StructField("started", TimestampType()),
        StructField("finished", TimestampType()),
        StructField("rows_loaded", LongType()),
        StructField("rows_rejected", LongType()),
        StructField("files_loaded", LongType()),
        StructField("files_skipped", LongType()),
    ]
)

# More bad files than this are no few damaged ones: the load stops.
MOST_SKIPPED = 1000
MAGIC = b"PAR1"


class TooManyBadFiles(Exception):
    """Raised when more files of a load cannot be read than can be left out by name."""


def listed(
    spark: SparkSession, path: str, days: Collection[date | None] | None = None
) -> DataFrame:
    """The files of a table with a folder per day, without opening one: columns of FILE and
    the day. Only the given days' folders are listed."""
    schema = StructType([*FILE.fields, StructField(PARTITION, DateType())])
    folders = [path] if days is None else [day_folder(path, day) for day in days]
    folders = [f for f in folders if exists(spark, f) and (days is not None or files_in(spark, f))]
    if not folders:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("basePath", path).load(folders)
    where = F.col("_metadata.file_path")
    day = F.regexp_extract(where, rf"/{PARTITION}=([^/]+)/", 1)
    return files.select(
        where.alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("changed"),
        F.when(~day.isin("", NO_DAY), day).cast("date").alias(PARTITION),
    )


def changed_days(files: DataFrame, manifest: DataFrame) -> set[date | None]:
    """Days with a file that is new, changed or gone since the manifest was written."""
    known = [*FILE.names, PARTITION]
    files, manifest = files.select(*known), manifest.select(*known)
    either = files.withColumn("side", F.lit(1)).unionByName(manifest.withColumn("side", F.lit(-1)))
    # One row per file, whatever the number of files of a day.
    differ = either.groupBy(*known).agg(F.sum("side").alias("side")).filter(F.col("side") != 0)
    return {row[0] for row in differ.select(PARTITION).distinct().toLocalIterator()}


def _no_parquet(content: Column, size: Column) -> Column:
    """Why bytes are no Parquet file, or NULL: it begins and ends with a mark, and before
    the last one is the length of the footer."""
    last = F.hex(F.substring(content, -8, 4))
    # The four bytes are in little-endian order.
    footer = F.conv(
        F.concat(*(F.substring(last, at, 2) for at in (7, 5, 3, 1))), 16, 10
    ).cast("long")
    mark = F.lit(MAGIC).cast("binary")
    return (
        F.when(size < 12, "too short")
        .when(F.substring(content, 1, 4) != mark, "no mark at its beginning")
        .when(F.substring(content, -4, 4) != mark, "no mark at its end")
        .when(footer > size - 12, "footer longer than the file")
    )


def bad_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    days: Collection[date | None] | None = None,
) -> list[tuple[str, str]]:
    """Path and reason of each file that is no whole Parquet file.

    Every file's footer is opened by a task. Those that did not open are looked at byte by byte:
    if their bytes cannot be fetched either, as when a connection is lost, the job fails,
    and a file that looks whole is not reported, so that reading it fails as well.
    """
    files = listed(spark, path, days)
    reader = spark.read.option("ignoreCorruptFiles", True).schema(schema)
    where = F.col("_metadata.file_path")
    # No column is read: the number of rows is in the footer.
    opened = on_days(reader.parquet(path), days).select(where.alias("path")).distinct()
    unopened = files.select("path").join(opened, "path", "left_anti")
    suspects = [row.path for row in unopened.take(MOST_SKIPPED + 1)]
    if not suspects:
        return []
    if len(suspects) > MOST_SKIPPED:
        raise TooManyBadFiles(f"more than {MOST_SKIPPED} files do not open, {suspects[0]} is one")
    whole = spark.read.format("binaryFile").option("basePath", path).load(path)
    reason = _no_parquet(F.col("content"), F.col("length"))
    found = whole.filter(where.isin(suspects)).select(where.alias("path"), reason.alias("reason"))
    return [(r.path, r.reason) for r in found.filter("reason is not null").sort("path").collect()]


def without(rows: DataFrame, bad: Collection[str]) -> DataFrame:
    """Rows of the other files; the given ones are left out of the listing and not opened."""
    return rows.filter(~F.col("_metadata.file_path").isin(list(bad))) if bad else rows


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    ensure(spark, path)
    return spark.read.schema(MANIFEST).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """A row for each load of each table."""
    ensure(spark, path)
    return spark.read.schema(HISTORY).parquet(path)


def next_load(spark: SparkSession, path: str) -> int:
    return (read_history(spark, path).agg(F.max("load_id")).first()[0] or 0) + 1


def record(
    spark: SparkSession,
    path: str,
    load_id: int,
    table: str,
    started: datetime,
    loaded: int,
    rejected: int = 0,
    files: int = 0,
    skipped: int = 0,
) -> None:
    """Append a load to the history."""
    row = (load_id, table, started, datetime.now(), loaded, rejected, files, skipped)
    spark.createDataFrame([row], HISTORY).coalesce(1).write.mode("append").parquet(path)
