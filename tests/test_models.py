"""Staging models, daily summary, marts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from collarlake.plans import models
from collarlake.schemas import STAGING_REGISTRY, STAGING_TELEMETRY
from tests.conftest import plan_of, rows

NOW = datetime(2026, 5, 2)


def staging(spark, *readings):
    """Rows of (collar, cat, time, heart, activity, steps, purr, temp, battery)."""
    return spark.createDataFrame([(*r, NOW, "f") for r in readings], STAGING_TELEMETRY)


def at(hour, day=1):
    return datetime(2026, 5, day, hour)


def test_missing_metrics_get_defaults_but_battery_does_not(spark):
    row = models.stg_telemetry(
        staging(spark, ("K", "C", at(1), None, None, None, None, None, None))
    ).first()
    assert row[4:10] == (-1, "unknown", 0, 0.0, 0.0, None)


def test_registry_texts_are_trimmed(spark):
    breeds = [None, "  ", " Tabby "]
    df = spark.createDataFrame(
        [("C", " Tom ", b, "MALE", None, None, None, None) for b in breeds], STAGING_REGISTRY
    )
    out = models.stg_registry(df)
    assert sorted(r.breed for r in out.collect()) == ["", "Mixed Breed", "Tabby"]
    assert rows(out.select("cat_name", "gender").distinct()) == [("Tom", "male")]
    assert out.columns == [n if n != "name" else "cat_name" for n in STAGING_REGISTRY.names]


def test_daily_summary(spark):
    df = staging(
        spark,
        ("K1", "C", at(1), -1, "sleep", 10, 0.0, 0.0, 50),
        ("K1", "C", at(2), 100, "sleep", 20, 1.0, 20.0, None),
        ("K2", "C", at(2), 101, "active", 30, 1.005, 21.0, -1),
        ("K1", "C", at(3), 101, "unknown", 40, 2.0, 21.0, 90),
        ("K1", "C", at(0, 2), -1, "lazy", 0, 0.0, 0.0, None),
    )
    out = {r.reading_date: r for r in models.daily_telemetry(df).collect()}
    first = out[date(2026, 5, 1)]
    assert first[3:] == (100.7, 100, 1.0, 15.5, -1, 120, 60, 0, 4)
    # No heart rate at all on the second day.
    assert out[date(2026, 5, 2)][3:] == (None, 0, 0.0, 0.0, None, 0, 0, 60, 1)


def test_daily_aggregate_reduces_before_the_shuffle(spark):
    plan = plan_of(models.daily_telemetry(staging(spark)))
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
    assert "SortAggregate" not in plan and "partial_avg" in plan.partition("Exchange")[2]


def daily_row(spark, heart, sleep, steps, battery):
    schema = (
        "daily_summary_id string, cat_id string, reading_date date, avg_heart_rate_bpm double, "
        "total_daily_steps bigint, avg_purr_frequency_hz double, avg_ambient_temp_c double, "
        "min_battery_level_pct int, estimated_sleep_minutes bigint, "
        "estimated_active_minutes bigint, estimated_lazy_minutes bigint, "
        "total_readings_logged bigint"
    )
    row = ("id", "C", date(2026, 5, 1), heart, steps, 1.0, 20.0, battery, sleep, 540, 0, 24)
    return spark.createDataFrame([row], schema)


def test_daily_health(spark):
    for given, expected in [
        ((None, 480, 500, 10), (100, "Excellent")),
        ((79.9, 420, 499, 9), (45, "Critical Care")),
        ((200.0, 1140, 500, 10), (85, "Excellent")),
        ((200.1, 480, 500, 10), (80, "Good")),
        ((200.1, 480, 499, 10), (65, "Needs Attention")),
    ]:
        out = models.daily_health(daily_row(spark, *given))
        assert out.first()[-2:] == expected
    assert not {"avg_ambient_temp_c", "min_battery_level_pct", "total_readings_logged"} & set(
        out.columns
    )


def dim_row(spark, cat):
    registry = spark.createDataFrame(
        [(cat, "Tom", "Tabby", "male", date(2023, 7, 1), 11.5, "O", date(2024, 1, 1))],
        STAGING_REGISTRY,
    )
    return models.dim_cats(models.stg_registry(registry), date(2026, 5, 1))


def test_dimension(spark):
    row = dim_row(spark, "C").first()
    assert (row.age_years, row.human_equivalent_age, row.weight_category) == (
        3, 28, "healthy weight",
    )


def test_flat_mart_keeps_days_without_profile(spark):
    days = models.daily_health(daily_row(spark, 120.0, 480, 500, 10))
    known = models.bi_flat(days, dim_row(spark, "C"))
    assert known.columns == list(models.BI_COLUMNS)
    row = known.first()
    assert (row.cat_id, row.cat_name, row.sleep_percentage_of_day) == ("C", "Tom", 33.3)
    assert row.active_percentage_of_day == 37.5
    unknown = models.bi_flat(days, dim_row(spark, "X")).first()
    assert unknown[1:9] == (None,) * 8 and unknown.daily_feline_health_score == 100


def test_fact_is_narrow(spark):
    fact = models.fact_readings(
        models.stg_telemetry(staging(spark, ("K", "C", at(1), None, "lazy", 1, 1.0, 1.0, -1)))
    )
    assert fact.columns[-2:] == ["low_battery_warning", "cardiac_status"]
    assert fact.first()[-2:] == (True, "sensor error")
    assert "Exchange" not in plan_of(fact)


def test_unused_key_is_not_computed(spark):
    plan = plan_of(models.daily_telemetry(models.stg_telemetry(staging(spark))))
    assert plan.count("md5") == 1
    assert "reading_id" not in plan


def test_null_day_has_its_own_row(spark):
    df = staging(spark, ("K", "C", None, 100, "sleep", 1, 1.0, 1.0, 5))
    out = models.daily_telemetry(df).select("cat_id", "reading_date", F.length("daily_summary_id"))
    assert rows(out) == [("C", None, 32)]
