"""Daily measures per animal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collarlake import constants as k


def minutes_of(activity: str) -> Column:
    """Estimated minutes: readings with this label, each standing for an hour."""
    return F.count(F.when(F.col("activity_level") == activity, 1)) * k.MINUTES_PER_READING


def daily_measures(readings: DataFrame) -> DataFrame:
    """Unrounded measures per (cat_id, reading_date).

    All buffers have a fixed width, so this is a hash aggregate with a partial step:
    what is shuffled has a row per animal, day and task, not a row per reading.
    """
    heart = F.col("heart_rate_bpm")
    return readings.groupBy("cat_id", F.col("reading_time").cast("date").alias("reading_date")).agg(
        F.avg(F.when(heart > 0, heart)).alias("avg_heart_rate_bpm"),
        F.sum("steps_count").alias("total_daily_steps"),
        F.avg("purr_frequency_hz").alias("avg_purr_frequency_hz"),
        F.avg("ambient_temp_c").alias("avg_ambient_temp_c"),
        F.min("battery_level_pct").alias("min_battery_level_pct"),
        minutes_of(k.SLEEP).alias("estimated_sleep_minutes"),
        minutes_of(k.ACTIVE).alias("estimated_active_minutes"),
        minutes_of(k.LAZY).alias("estimated_lazy_minutes"),
        F.count(F.lit(1)).alias("total_readings_logged"),
    )
