"""How far the marts follow bronze and the registry, and what is left to rebuild.

After a run whose checks passed, a mark is written: the last ingested batch that is in the
marts, and a fingerprint of each animal's profile as it is in them. The next run compares.
A lost or missing mark means that everything is to be rebuilt.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collarlake.schemas import BATCH, BRONZE_FILES, RAW_DAY
from collarlake.sources import tables
from collarlake.streaming import bronze

MARK = f"{BATCH} long, version long"
PROFILES = "cat_id string, profile long"


class Mark(NamedTuple):
    batch: int
    version: int


def last(spark: SparkSession, path: str) -> Mark | None:
    """The mark of the last run whose checks passed, if it is there and whole."""
    if not tables.files_in(spark, path):
        return None
    row = spark.read.schema(MARK).parquet(path).first()
    return None if row is None else Mark(row[BATCH], row.version)


def profiles(cats: DataFrame) -> DataFrame:
    """A fingerprint of each animal's row in the dimension."""
    return cats.select("cat_id", F.xxhash64(*cats.columns).alias("profile"))


def _version(path: str, version: int) -> str:
    return f"{path}/version={version}"


def commit(spark: SparkSession, mark_path: str, profiles_path: str, cats: DataFrame, batch: int) -> None:
    """Write the mark of a run. The fingerprints go to a folder of their own first; the mark
    that names it is written last."""
    before = last(spark, mark_path)
    version = 1 + (before.version if before else 0)
    tables.overwrite(profiles(cats), _version(profiles_path, version))
    mark = spark.createDataFrame([(batch, version)], MARK).coalesce(1)
    tables.overwrite(mark, mark_path)
    for name in tables.files_in(spark, profiles_path):
        if name != f"version={version}":
            tables.remove(spark, f"{profiles_path}/{name}")


class Changes(NamedTuple):
    """Animals that came or went since a mark, and animals whose profile is another."""

    moved: DataFrame
    altered: DataFrame


def changes(spark: SparkSession, profiles_path: str, mark: Mark, cats: DataFrame) -> Changes:
    old = spark.read.schema(PROFILES).parquet(_version(profiles_path, mark.version))
    either = (
        profiles(cats)
        .withColumn("side", F.lit(1))
        .unionByName(old.withColumn("side", F.lit(-1)))
        .filter("cat_id is not null")
    )
    # One row per animal: on which sides it is, and whether its profiles are the same.
    one = either.groupBy("cat_id").agg(
        F.max("side").alias("now"),
        F.min("side").alias("then"),
        (F.min("profile") != F.max("profile")).alias("differs"),
    )
    return Changes(
        one.filter("now = then").select("cat_id"), one.filter("now <> then and differs").select("cat_id")
    )


def days_with(rows: DataFrame, day: str, animals: DataFrame) -> set[date | None]:
    """Days on which some of the animals have rows. Two columns are read, and nothing at all
    if there are no such animals."""
    if animals.isEmpty():
        return set()
    found = rows.select(day, "cat_id").join(animals, "cat_id", "left_semi").select(day).distinct()
    return {row[0] for row in found.toLocalIterator()}


def days_since(spark: SparkSession, bronze_path: str, mark: Mark, moved: DataFrame) -> set[date | None]:
    """Days to rebuild: those that later batches brought readings of, and those with readings
    of animals that came to the registry or left it."""
    days = bronze.days_of_batches(spark, bronze_path, mark.batch)
    rows = spark.read.schema(BRONZE_FILES).parquet(bronze_path)
    return days | days_with(rows, RAW_DAY, moved)

