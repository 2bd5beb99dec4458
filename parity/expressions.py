"""Projections and scalar expressions, each on the table where its rule applies."""

from __future__ import annotations

from pyspark.sql import functions as F

from collarlake.functions import cleaning, health, profile
from collarlake.functions.keys import surrogate_key
from collarlake.functions.numbers import INTEGER_AVERAGE_SCALE, round_half_up
from collarlake.operators.dashboard import display_profiles, select_days
from collarlake.operators.daily import daily_measures
from collarlake.plans import models
from collarlake.schemas import RAW_TELEMETRY
from collarlake.sources.telemetry import split_load
from parity import adapter, chain
from parity.catalog import query

READING = ("collar_id", "ingested_at")


@query("src_schema", "select * exclude (ingested_at, source_file) from raw")
def src_schema(spark, sf_dir):
    raw = adapter.raw(spark, sf_dir)
    return raw.select(*(F.col(f.name).cast(f.dataType) for f in RAW_TELEMETRY))


@query(
    "parse_reading_time",
    "select collar_id, ingested_at, reading_time, parsed_reading_time from raw_timed",
)
def parse_reading_time(spark, sf_dir):
    parsed = cleaning.parse_reading_time(F.col("reading_time"))
    return adapter.raw(spark, sf_dir).select(
        *READING, "reading_time", parsed.alias("parsed_reading_time")
    )


@query("clean_heart_rate", f"select collar_id, ingested_at, {chain.HEART} as heart_rate_bpm from raw")
def clean_heart_rate(spark, sf_dir):
    value = cleaning.clean_heart_rate(F.col("heart_rate_bpm"))
    return adapter.raw(spark, sf_dir).select(*READING, value.alias("heart_rate_bpm"))


@query("clean_battery", f"select collar_id, ingested_at, {chain.BATTERY} as battery_level_pct from raw")
def clean_battery(spark, sf_dir):
    value = cleaning.clean_battery(F.col("battery_level_pct"))
    return adapter.raw(spark, sf_dir).select(*READING, value.alias("battery_level_pct"))


@query("clean_steps", f"select collar_id, ingested_at, {chain.STEPS} as steps_count from raw")
def clean_steps(spark, sf_dir):
    value = cleaning.clean_steps(F.col("steps_count"))
    return adapter.raw(spark, sf_dir).select(*READING, value.alias("steps_count"))


@query("clean", "select * from cleaned")
def clean(spark, sf_dir):
    return adapter.cleaned(spark, sf_dir)


@query(
    "load_cast_project",
    """select collar_id, cat_id, parsed_reading_time as reading_time, heart_rate_bpm,
              activity_level, steps_count, purr_frequency_hz, ambient_temp_c,
              battery_level_pct, ingested_at, source_file from silver""",
)
def load_cast_project(spark, sf_dir):
    return split_load(adapter.silver_table(spark, sf_dir)).loaded


@query("reading_key", "select reading_id, collar_id, reading_time from staged")
def reading_key(spark, sf_dir):
    staging = adapter.staging(spark, sf_dir)
    key = surrogate_key(staging, "collar_id", "reading_time")
    return staging.select(key.alias("reading_id"), "collar_id", "reading_time")


@query("daily_key", "select daily_summary_id, cat_id, reading_date from daily")
def daily_key(spark, sf_dir):
    days = daily_measures(adapter.staged(spark, sf_dir))
    key = surrogate_key(days, "cat_id", "reading_date")
    return days.select(key.alias("daily_summary_id"), "cat_id", "reading_date")


@query(
    "stg_defaults",
    """select reading_id, heart_rate_bpm, activity_level, steps_count, purr_frequency_hz,
              ambient_temp_c, battery_level_pct from staged""",
)
def stg_defaults(spark, sf_dir):
    return adapter.staged(spark, sf_dir).select(
        "reading_id", "heart_rate_bpm", "activity_level", "steps_count", "purr_frequency_hz",
        "ambient_temp_c", "battery_level_pct",
    )


@query("stg_telemetry", "select * from staged")
def stg_telemetry(spark, sf_dir):
    return adapter.staged(spark, sf_dir)


@query("stg_registry_clean", "select * from stg_registry")
def stg_registry_clean(spark, sf_dir):
    return adapter.staged_registry(spark, sf_dir)


@query("rename_cols", "select cat_id, trim(name) as cat_name from registry")
def rename_cols(spark, sf_dir):
    return adapter.staged_registry(spark, sf_dir).select("cat_id", "cat_name")


@query("to_reading_date", "select reading_id, cast(reading_time as date) as reading_date from staged")
def to_reading_date(spark, sf_dir):
    staged = adapter.staged(spark, sf_dir)
    return staged.select("reading_id", F.col("reading_time").cast("date").alias("reading_date"))


@query(
    "round_daily",
    f"""select cat_id, reading_date, {chain.rounded("heart", 1, 6)} as avg_heart_rate_bpm,
               {chain.rounded("purr", 2)} as avg_purr_frequency_hz,
               {chain.rounded("temp", 2)} as avg_ambient_temp_c from measures""",
)
def round_daily(spark, sf_dir):
    heart, purr, temp = "avg_heart_rate_bpm", "avg_purr_frequency_hz", "avg_ambient_temp_c"
    return daily_measures(adapter.staged(spark, sf_dir)).select(
        "cat_id",
        "reading_date",
        round_half_up(F.col(heart), 1, INTEGER_AVERAGE_SCALE).alias(heart),
        round_half_up(F.col(purr), 2).alias(purr),
        round_half_up(F.col(temp), 2).alias(temp),
    )


@query("age_years", f"select cat_id, birth_date, {chain.AGE} as age_years from stg_registry")
def age_years(spark, sf_dir):
    age = profile.age_years(F.col("birth_date"), profile.as_of_date(adapter.AS_OF))
    return adapter.staged_registry(spark, sf_dir).select(
        "cat_id", "birth_date", age.alias("age_years")
    )


@query("human_age", "select cat_id, age_years, human_equivalent_age from dim")
def human_age(spark, sf_dir):
    age = profile.age_years(F.col("birth_date"), profile.as_of_date(adapter.AS_OF))
    aged = adapter.staged_registry(spark, sf_dir).select("cat_id", age.alias("age_years"))
    human = profile.human_equivalent_age(F.col("age_years"))
    return aged.withColumn("human_equivalent_age", human)


@query("weight_category", f"select cat_id, weight_lbs, {chain.WEIGHT} as weight_category from registry")
def weight_category(spark, sf_dir):
    category = profile.weight_category(F.col("weight_lbs"))
    return adapter.staged_registry(spark, sf_dir).select(
        "cat_id", "weight_lbs", category.alias("weight_category")
    )


@query("dim_cats", "select * from dim")
def dim_cats(spark, sf_dir):
    return adapter.dim(spark, sf_dir)


@query(
    "low_battery_flag",
    f"select reading_id, battery_level_pct, {chain.LOW_BATTERY} as low_battery_warning from staged",
)
def low_battery_flag(spark, sf_dir):
    flag = health.low_battery_warning(F.col("battery_level_pct"))
    return adapter.staged(spark, sf_dir).select(
        "reading_id", "battery_level_pct", flag.alias("low_battery_warning")
    )


@query(
    "cardiac_status",
    f"select reading_id, heart_rate_bpm, {chain.CARDIAC} as cardiac_status from staged",
)
def cardiac_status(spark, sf_dir):
    status = health.cardiac_status(F.col("heart_rate_bpm"))
    return adapter.staged(spark, sf_dir).select(
        "reading_id", "heart_rate_bpm", status.alias("cardiac_status")
    )


@query("fact_project", "select * from fact")
def fact_project(spark, sf_dir):
    return adapter.fact(spark, sf_dir)


@query("health_score_raw", f"select daily_summary_id, {chain.SCORE} as computed_score from daily")
def health_score_raw(spark, sf_dir):
    days = models.scored_days(adapter.daily(spark, sf_dir))
    return days.select("daily_summary_id", "computed_score")


@query(
    "health_score_clamp",
    f"""select daily_summary_id, {chain.CLAMPED} as daily_feline_health_score
        from (select *, {chain.SCORE} as computed_score from daily)""",
)
def health_score_clamp(spark, sf_dir):
    clamped = health.health_score_clamped(F.col("computed_score"))
    return models.scored_days(adapter.daily(spark, sf_dir)).select(
        "daily_summary_id", clamped.alias("daily_feline_health_score")
    )


@query(
    "health_category",
    f"""select daily_summary_id, computed_score, {chain.CATEGORY} as health_status_category
        from (select *, {chain.SCORE} as computed_score from daily)""",
)
def health_category(spark, sf_dir):
    category = health.health_category(F.col("computed_score"))
    return models.scored_days(adapter.daily(spark, sf_dir)).select(
        "daily_summary_id", "computed_score", category.alias("health_status_category")
    )


@query("daily_health_project", "select * from health")
def daily_health_project(spark, sf_dir):
    return adapter.health(spark, sf_dir)


@query(
    "pct_of_day",
    f"""select daily_summary_id,
               {chain.percent("estimated_sleep_minutes")} as sleep_percentage_of_day,
               {chain.percent("estimated_active_minutes")} as active_percentage_of_day
        from health""",
)
def pct_of_day(spark, sf_dir):
    share = health.percent_of_day
    return adapter.health(spark, sf_dir).select(
        "daily_summary_id",
        share(F.col("estimated_sleep_minutes")).alias("sleep_percentage_of_day"),
        share(F.col("estimated_active_minutes")).alias("active_percentage_of_day"),
    )


@query(
    "display_gender",
    """select distinct cat_id, cat_name, breed,
              upper(gender[1]) || lower(gender[2:]) as gender, age_years,
              human_equivalent_age, weight_lbs, weight_category
       from shown where cat_id is not null""",
)
def display_gender(spark, sf_dir):
    return display_profiles(select_days(adapter.bi(spark, sf_dir)))


@query(
    "heart_rate_zone",
    """select daily_summary_id, avg_heart_rate_bpm,
              case when avg_heart_rate_bpm < 100 then 'low'
                   when avg_heart_rate_bpm <= 180 then 'normal'
                   when avg_heart_rate_bpm > 180 then 'high' end as heart_rate_zone
       from health""",
)
def heart_rate_zone(spark, sf_dir):
    zone = health.heart_rate_zone(F.col("avg_heart_rate_bpm"))
    return adapter.health(spark, sf_dir).select(
        "daily_summary_id", "avg_heart_rate_bpm", zone.alias("heart_rate_zone")
    )
