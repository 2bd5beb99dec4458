"""Silver: cleaned, deduplicated readings of registered animals."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collarlake.functions import cleaning
from collarlake.operators.joins import join_profiles
from collarlake.operators.latest import latest_row

READING_KEY = ("collar_id", "parsed_reading_time")


def clean(bronze: DataFrame) -> DataFrame:
    """Parse the time and put sensor values outside their ranges right. Narrow: no shuffle."""
    return bronze.withColumns(
        {
            "parsed_reading_time": cleaning.parse_reading_time(F.col("reading_time")),
            "heart_rate_bpm": cleaning.clean_heart_rate(F.col("heart_rate_bpm")),
            "battery_level_pct": cleaning.clean_battery(F.col("battery_level_pct")),
            "steps_count": cleaning.clean_steps(F.col("steps_count")),
        }
    )


def dedup_latest(cleaned: DataFrame) -> DataFrame:
    """One row per collar and time: the one ingested last.

    A micro-batch gives all its rows the same ingest time, so ties are settled by the
    source file, then by the other columns.
    """
    return latest_row(cleaned, READING_KEY, ("ingested_at", "source_file"))


def silver(
    bronze: DataFrame,
    registry: DataFrame,
    salts: int | None = None,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """The silver table. Readings without a registered animal are dropped."""
    return join_profiles(
        dedup_latest(clean(bronze)),
        registry,
        spread_by=READING_KEY,
        salts=salts,
        broadcast_limit=broadcast_limit,
    )


def _day(text: Column) -> Column:
    return cleaning.parse_reading_time(text).cast("date")


def readings_on(bronze: DataFrame, days: Collection[date | None]) -> DataFrame:
    """Readings of the given days; None stands for those without a valid time.

    The raw time is text in a fixed-width format, so a range of days is a range of
    texts. Written this way the range reaches the Parquet reader and skips row groups,
    unless None is among the days.
    """
    text = F.col("reading_time")
    dated = sorted(day for day in days if day is not None)
    wanted = F.lit(False)
    if dated:
        after = dated[-1] + timedelta(days=1)
        in_range = (text >= dated[0].isoformat()) & (text < after.isoformat())
        wanted = in_range & _day(text).isin(dated)
    if None in days:
        wanted = wanted | _day(text).isNull()
    return bronze.filter(wanted)
