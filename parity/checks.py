"""The data checks, on readings that were not cleaned, so that they find failures."""

from __future__ import annotations

from collarlake.operators import quality
from collarlake.plans import models
from collarlake.sources.registry import type_registry
from parity import adapter
from parity.catalog import query


@query("dq_not_null", "select collar_id, reading_time, ingested_at from raw where cat_id is null")
def dq_not_null(spark, sf_dir):
    rows = quality.null_rows(adapter.raw(spark, sf_dir), "cat_id")
    return rows.select("collar_id", "reading_time", "ingested_at")


@query(
    "dq_unique",
    "select reading_id, count(*) as n_rows from raw_staged group by all having count(*) > 1",
)
def dq_unique(spark, sf_dir):
    return quality.duplicate_values(adapter.raw_staged(spark, sf_dir), "reading_id")


@query(
    "dq_relationship",
    """select cat_id, count(*) as n_rows from raw_staged
       where cat_id is not null and cat_id not in (select cat_id from dim) group by all""",
)
def dq_relationship(spark, sf_dir):
    fact = models.fact_readings(adapter.raw_staged(spark, sf_dir))
    return quality.orphan_values(fact, adapter.dim(spark, sf_dir), "cat_id")


IMPOSSIBLE = "(heart_rate_bpm > 250 or heart_rate_bpm < 0 and heart_rate_bpm <> -1)"


@query(
    "dq_heart_rate_valid",
    f"select reading_id, cat_id, heart_rate_bpm from raw_staged where {IMPOSSIBLE}",
)
def dq_heart_rate_valid(spark, sf_dir):
    return quality.impossible_heart_rates(adapter.raw_staged(spark, sf_dir))


@query(
    "dq_sleep_over_24h",
    """select daily_summary_id, cat_id, reading_date, estimated_sleep_minutes from raw_daily
       where estimated_sleep_minutes > 1440""",
)
def dq_sleep_over_24h(spark, sf_dir):
    return quality.days_longer_than_a_day(
        models.daily_telemetry(adapter.raw_staged(spark, sf_dir))
    )


@query(
    "dq_unparsed_times",
    """select collar_id, count(*) as n_rows from raw_timed where parsed_reading_time is null
       group by all""",
)
def dq_unparsed_times(spark, sf_dir):
    return quality.unparsed_times(adapter.cleaned(spark, sf_dir))


def _nulls(label: str, source: str, column: str) -> str:
    return (
        f"select '{label}' as \"table\", 'not_null {column}' as \"check\", "
        f"count(*) filter ({column} is null) as failures from {source}"
    )


def _repeats(label: str, source: str, column: str) -> str:
    return (
        f"select '{label}', 'unique {column}', count(*) from (select {column} from {source} "
        f"where {column} is not null group by {column} having count(*) > 1)"
    )


REPORT = " union all ".join(
    [
        _nulls("staging_telemetry", "raw", "collar_id"),
        _nulls("staging_telemetry", "raw", "cat_id"),
        _nulls("staging_registry", "registry", "cat_id"),
        _repeats("staging_registry", "registry", "cat_id"),
        _nulls("stg_telemetry", "raw_staged", "reading_id"),
        "select 'stg_telemetry', 'heart rate possible', "
        f"count(*) filter {IMPOSSIBLE} from raw_staged",
        _repeats("stg_telemetry", "raw_staged", "reading_id"),
        _nulls("dim_cats", "dim", "cat_id"),
        _repeats("dim_cats", "dim", "cat_id"),
        _nulls("fact_readings", "raw_staged", "reading_id"),
        _nulls("fact_readings", "raw_staged", "cat_id"),
        _repeats("fact_readings", "raw_staged", "reading_id"),
        "select 'fact_readings', 'cat_id in dim_cats', count(distinct cat_id) from raw_staged "
        "where cat_id not in (select cat_id from dim)",
        _nulls("daily_health", "raw_health", "daily_summary_id"),
        _repeats("daily_health", "raw_health", "daily_summary_id"),
    ]
)


@query("dq_report", REPORT)
def dq_report(spark, sf_dir):
    """All checks at once, as run after every build."""
    staged = adapter.raw_staged(spark, sf_dir)
    return quality.check_report(
        {
            "staging_telemetry": adapter.raw(spark, sf_dir),
            "staging_registry": type_registry(adapter.registry_text(spark, sf_dir)),
            "stg_telemetry": staged,
            "dim_cats": adapter.dim(spark, sf_dir),
            "fact_readings": models.fact_readings(staged),
            "daily_health": models.daily_health(models.daily_telemetry(staged)),
        }
    )
