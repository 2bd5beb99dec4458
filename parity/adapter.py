"""Views that give the given tables the shape of collar readings and of the registry."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collarlake.plans import models
from collarlake.plans.silver import clean, dedup_latest, silver
from collarlake.sources.registry import type_registry
from collarlake.sources.telemetry import split_load

AS_OF = date(2026, 5, 1)

RAW_COLUMNS = """
    'K' || cast(user_id as string) as collar_id,
    case when event_id % 211 = 0 then null
         when user_id % 10 = 0 then 'S' || cast(user_id as string)
         else 'C' || cast(user_id as string) end as cat_id,
    case when event_id % 97 = 0 then 'no time'
         else {hour_text} end as reading_time,
    cast(floor(value) as int) as heart_rate_bpm,
    case when event_type = 'view' then 'sleep'
         when event_type = 'click' then 'active'
         when event_type = 'error' then null
         else 'lazy' end as activity_level,
    cast(floor(value * 10) as int) - 50 as steps_count,
    case when event_id % 11 = 0 then null else value / 10 end as purr_frequency_hz,
    case when event_id % 7 = 0 then null else cast(event_id % 40 as double) end as ambient_temp_c,
    case when event_id % 17 = 0 then null
         else cast(event_id % 131 as int) - 10 end as battery_level_pct,
    cast(ts as timestamp) as ingested_at,
    'landing/' || cast(event_id % 16 as string) || '.json' as source_file
"""

REGISTRY_COLUMNS = """
    'C' || cast(c_custkey as string) as cat_id,
    '  ' || c_name || ' ' as name,
    case when c_mktsegment = 'MACHINERY' then null else ' ' || c_mktsegment end as breed,
    case when c_custkey % 2 = 0 then 'Female' else 'MALE' end as gender,
    case when c_custkey % 23 = 0 then null
         else date '2012-01-01' + cast(c_custkey * 37 % 5000 as int) end as birth_date,
    case when c_custkey % 19 = 0 then null
         else 4.0 + cast(c_custkey % 160 as double) / 10 end as weight_lbs,
    'O' || cast(c_custkey % 700 as string) as owner_id,
    date '2020-01-01' + cast(c_custkey % 1500 as int) as registered_at
"""


# The given tables' columns that the views use. Naming them saves a job per read.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _select(df: DataFrame, columns: str) -> DataFrame:
    # The columns are one SQL select list, the same text the oracle uses.
    return df.sparkSession.sql(f"select {columns} from {{source}}", source=df)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze: readings as they arrive, with audit columns.

    Some times are no valid text, some cats are missing, and cats whose id starts with S
    are not in the registry.
    """
    hour_text = "date_format(date_trunc('hour', ts), 'yyyy-MM-dd HH:mm:ss')"
    return _select(table(spark, sf_dir, "events"), RAW_COLUMNS.format(hour_text=hour_text))


def registry_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry with types."""
    return _select(table(spark, sf_dir, "customer"), REGISTRY_COLUMNS)


def registry_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry as its CSV file holds it: all text."""
    typed = registry_typed(spark, sf_dir)
    return typed.select(*(F.col(n).cast("string").alias(n) for n in typed.columns))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw(spark, sf_dir))


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(cleaned(spark, sf_dir))


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(raw(spark, sf_dir), registry_text(spark, sf_dir))


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_load(silver_table(spark, sf_dir)).loaded


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.stg_telemetry(staging(spark, sf_dir))


def raw_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as they arrive, staged without cleaning, so that checks find failures."""
    arrived = raw(spark, sf_dir).withColumn(
        "parsed_reading_time", F.try_to_timestamp("reading_time", F.lit("yyyy-MM-dd HH:mm:ss"))
    )
    return models.stg_telemetry(split_load(arrived).loaded)


def staged_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.stg_registry(type_registry(registry_text(spark, sf_dir)))


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.dim_cats(staged_registry(spark, sf_dir), AS_OF)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.fact_readings(staged(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.daily_telemetry(staged(spark, sf_dir))


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.daily_health(daily(spark, sf_dir))


def bi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: the flat mart, from raw readings and the registry."""
    return models.bi_flat(health(spark, sf_dir), dim(spark, sf_dir))


def unmatched_bi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat mart without silver's inner join, so that the left join finds days without a cat."""
    readings = models.stg_telemetry(split_load(deduplicated(spark, sf_dir)).loaded)
    days = models.daily_health(models.daily_telemetry(readings))
    return models.bi_flat(days, dim(spark, sf_dir))
