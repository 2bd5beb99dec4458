"""Loading silver files into the typed staging table."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from collarlake.schemas import BRONZE, BRONZE_FILES, RAW_DAY, STAGING_TELEMETRY
from collarlake.sources.loads import without
from collarlake.sources.tables import day_folder, exists, on_days

# Staging column -> silver column, where the names differ.
RENAMED = {"reading_time": "parsed_reading_time"}


class Load(NamedTuple):
    """Rows that fit the staging table, and rows that do not, with the reasons."""

    loaded: DataFrame
    rejected: DataFrame


def read_bronze(
    spark: SparkSession, path: str, days: Collection[date | None] | None = None
) -> DataFrame:
    """Bronze as a batch, or only the given days of it; other days' folders are not even
    listed. None among the days stands for readings without a valid time."""
    reader = spark.read.schema(BRONZE_FILES)
    if days is None:
        return reader.parquet(path).select(*BRONZE.names)
    folders = [day_folder(path, day, RAW_DAY) for day in days]
    folders = [folder for folder in folders if exists(spark, folder)]
    if not folders:
        return spark.createDataFrame([], BRONZE)
    rows = reader.option("basePath", path).parquet(*folders)
    return on_days(rows, days, RAW_DAY).select(*BRONZE.names)


def _source(df: DataFrame, field: StructField) -> StructField | None:
    """The column of ``df`` that the staging column is loaded from, if there is one."""
    name = RENAMED.get(field.name, field.name)
    return df.schema[name] if name in df.columns else None


def _typed(df: DataFrame, field: StructField) -> Column:
    source = _source(df, field)
    if source is None:
        return F.lit(None).cast(field.dataType)
    value = F.col(source.name)
    return value if source.dataType == field.dataType else value.try_cast(field.dataType)


def _does_not_fit(df: DataFrame, field: StructField) -> Column | None:
    """Whether a row's value does not fit the column; None where every value does."""
    source = _source(df, field)
    if source is None:
        return None
    tests = []
    if source.dataType != field.dataType:
        tests.append(F.col(source.name).isNotNull() & _typed(df, field).isNull())
    if "max_length" in field.metadata:
        too_long = F.length(_typed(df, field)) > field.metadata["max_length"]
        tests.append(F.coalesce(too_long, F.lit(False)))
    return reduce(or_, tests) if tests else None


def _text(df: DataFrame, field: StructField) -> Column:
    source = _source(df, field)
    return F.lit(None).cast("string") if source is None else F.col(source.name).cast("string")


def split_load(df: DataFrame, counts: Observation | None = None) -> Load:
    """Project to the staging columns, and set rows apart that have a value that does not fit.

    ``df`` has the silver columns and, as ``ingested_at`` and ``source_file``, the load
    time and file name, which replace those of bronze. Columns that a file lacks are NULL.

    ``counts`` gets the number of ``rows`` and of those ``rejected`` once ``loaded`` was written.
    They are counted on the way, so the files need a second pass only if there are any.
    """
    fields = list(STAGING_TELEMETRY)
    tests = {f.name: _does_not_fit(df, f) for f in fields}
    tests = {name: test for name, test in tests.items() if test is not None}
    fails = reduce(or_, tests.values())
    observed = df
    if counts is not None:
        rows, rejected = F.count(F.lit(1)).alias("rows"), F.count_if(fails).alias("rejected")
        observed = df.observe(counts, rows, rejected)
    loaded = observed.filter(~fails).select(*(_typed(df, f).alias(f.name) for f in fields))
    reasons = F.array(*(F.when(test, F.lit(name)) for name, test in tests.items()))
    rejected = df.filter(fails).select(
        *(_text(df, f).alias(f.name) for f in fields),
        F.array_compact(reasons).alias("bad_columns"),
    )
    return Load(loaded, rejected)


def with_load_audit(df: DataFrame) -> DataFrame:
    """Load time and the file each row came from, in place of earlier audit columns."""
    return df.withColumns(
        {"ingested_at": F.current_timestamp(), "source_file": F.col("_metadata.file_path")}
    )


def load_telemetry(
    spark: SparkSession,
    path: str,
    days: Collection[date | None] | None = None,
    counts: Observation | None = None,
    skip: Collection[str] = (),
    schema: StructType | None = None,
) -> Load:
    """Load silver files. Records that do not fit do not stop the load.

    ``days`` limits the load to silver's folders of these days. The files named in ``skip``
    are left out: ``loads.bad_files`` finds those that are damaged. Any other file that cannot be
    read stops the load. ``schema`` is that of silver, which an empty table cannot tell.
    """
    silver = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    return split_load(with_load_audit(without(on_days(silver, days), skip)), counts)
