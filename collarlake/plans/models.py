"""The models: staging, daily summary, dimension, fact, daily health and the flat mart."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collarlake import constants as k
from collarlake.functions import health, profile
from collarlake.functions.cleaning import default_to
from collarlake.functions.keys import surrogate_key
from collarlake.functions.numbers import INTEGER_AVERAGE_SCALE, round_half_up
from collarlake.operators.daily import daily_measures
from collarlake.operators.joins import limited


def stg_telemetry(staging: DataFrame) -> DataFrame:
    """Staged readings with a key, and defaults for missing metrics. Battery has none."""
    return staging.select(
        surrogate_key(staging, "collar_id", "reading_time").alias("reading_id"),
        "collar_id",
        "cat_id",
        "reading_time",
        default_to(F.col("heart_rate_bpm"), k.MISSING_SENSOR).alias("heart_rate_bpm"),
        default_to(F.col("activity_level"), k.UNKNOWN_ACTIVITY).alias("activity_level"),
        default_to(F.col("steps_count"), 0).alias("steps_count"),
        default_to(F.col("purr_frequency_hz"), 0.0).alias("purr_frequency_hz"),
        default_to(F.col("ambient_temp_c"), 0.0).alias("ambient_temp_c"),
        "battery_level_pct",
        "ingested_at",
        "source_file",
    )


def stg_registry(staging: DataFrame) -> DataFrame:
    """Registry with trimmed texts. A blank breed is kept as an empty text."""
    return staging.select(
        "cat_id",
        F.trim("name").alias("cat_name"),
        default_to(F.trim("breed"), k.DEFAULT_BREED).alias("breed"),
        F.lower("gender").alias("gender"),
        "birth_date",
        "weight_lbs",
        "owner_id",
        "registered_at",
    )


def daily_telemetry(readings: DataFrame) -> DataFrame:
    """Rounded daily measures per animal, with a key."""
    daily = daily_measures(readings)
    return daily.select(
        surrogate_key(daily, "cat_id", "reading_date").alias("daily_summary_id"),
        "cat_id",
        "reading_date",
        round_half_up(F.col("avg_heart_rate_bpm"), 1, INTEGER_AVERAGE_SCALE).alias(
            "avg_heart_rate_bpm"
        ),
        "total_daily_steps",
        round_half_up(F.col("avg_purr_frequency_hz"), 2).alias("avg_purr_frequency_hz"),
        round_half_up(F.col("avg_ambient_temp_c"), 2).alias("avg_ambient_temp_c"),
        "min_battery_level_pct",
        "estimated_sleep_minutes",
        "estimated_active_minutes",
        "estimated_lazy_minutes",
        "total_readings_logged",
    )


def dim_cats(registry: DataFrame, as_of: date | None = None) -> DataFrame:
    """Profiles with age, human-equivalent age and weight class."""
    aged = registry.withColumn(
        "age_years", profile.age_years(F.col("birth_date"), profile.as_of_date(as_of))
    )
    return aged.select(
        "cat_id",
        "cat_name",
        "breed",
        "gender",
        "birth_date",
        "weight_lbs",
        "age_years",
        profile.human_equivalent_age(F.col("age_years")).alias("human_equivalent_age"),
        profile.weight_category(F.col("weight_lbs")).alias("weight_category"),
        "owner_id",
        "registered_at",
    )


def fact_readings(readings: DataFrame) -> DataFrame:
    """Readings with a battery flag and a cardiac status. Narrow: no shuffle."""
    return readings.drop("ingested_at", "source_file").withColumns(
        {
            "low_battery_warning": health.low_battery_warning(F.col("battery_level_pct")),
            "cardiac_status": health.cardiac_status(F.col("heart_rate_bpm")),
        }
    )


def scored_days(daily: DataFrame) -> DataFrame:
    """Daily rows with the score before clamping. The score uses the rounded heart rate."""
    return daily.withColumn(
        "computed_score",
        health.health_score_raw(
            F.col("avg_heart_rate_bpm"),
            F.col("estimated_sleep_minutes"),
            F.col("total_daily_steps"),
            F.col("min_battery_level_pct"),
        ),
    )


def daily_health(daily: DataFrame) -> DataFrame:
    """Daily rows with health score and category."""
    raw = F.col("computed_score")
    return scored_days(daily).select(
        "daily_summary_id",
        "cat_id",
        "reading_date",
        "avg_heart_rate_bpm",
        "total_daily_steps",
        "avg_purr_frequency_hz",
        "estimated_sleep_minutes",
        "estimated_active_minutes",
        "estimated_lazy_minutes",
        health.health_score_clamped(raw).alias("daily_feline_health_score"),
        health.health_category(raw).alias("health_status_category"),
    )


BI_COLUMNS = (
    "daily_summary_id",
    "cat_id",
    "cat_name",
    "breed",
    "gender",
    "age_years",
    "human_equivalent_age",
    "weight_lbs",
    "weight_category",
    "reading_date",
    "avg_heart_rate_bpm",
    "total_daily_steps",
    "avg_purr_frequency_hz",
    "estimated_sleep_minutes",
    "estimated_active_minutes",
    "estimated_lazy_minutes",
    "daily_feline_health_score",
    "health_status_category",
    "sleep_percentage_of_day",
    "active_percentage_of_day",
)


def bi_flat(days: DataFrame, cats: DataFrame) -> DataFrame:
    """Days joined with profiles, flat, for dashboards.

    Days without a profile are kept; their ``cat_id`` is NULL because it is the
    profile's. An animal has one row per day here, so no join key is hot.
    """
    joined = days.alias("h").join(
        limited(cats).alias("c"), F.col("h.cat_id") == F.col("c.cat_id"), "left"
    )
    shares = {
        "sleep_percentage_of_day": health.percent_of_day(F.col("estimated_sleep_minutes")),
        "active_percentage_of_day": health.percent_of_day(F.col("estimated_active_minutes")),
    }
    return joined.drop(F.col("h.cat_id")).withColumns(shares).select(*BI_COLUMNS)
