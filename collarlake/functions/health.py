"""Flags on single readings, and the daily health score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from collarlake import constants as k


def low_battery_warning(pct: Column) -> Column:
    """True at or below the limit, -1 included; false when missing."""
    return F.coalesce(pct <= k.LOW_BATTERY_AT, F.lit(False))


def cardiac_status(bpm: Column) -> Column:
    return (
        F.when(bpm > k.DISTRESS_ABOVE, "high/distress")
        .when((bpm > 0) & (bpm < k.BRADYCARDIA_BELOW), "bradycardia/low")
        .when(bpm == k.MISSING_SENSOR, "sensor error")
        .otherwise("normal")
    )


def _penalty(condition: Column, points: int) -> Column:
    """Points lost. A condition on a missing value is not met."""
    return F.when(condition, points).otherwise(0)


def health_score_raw(heart: Column, sleep: Column, steps: Column, battery: Column) -> Column:
    """Full score minus a penalty for each measure outside its limits."""
    return (
        F.lit(k.SCORE_BASE)
        - _penalty((heart > k.SCORE_HEART_HIGH) | (heart < k.SCORE_HEART_LOW), k.HEART_PENALTY)
        - _penalty((sleep < k.SCORE_SLEEP_LOW) | (sleep > k.SCORE_SLEEP_HIGH), k.SLEEP_PENALTY)
        - _penalty(steps < k.SCORE_STEPS_LOW, k.STEPS_PENALTY)
        - _penalty(battery < k.SCORE_BATTERY_LOW, k.BATTERY_PENALTY)
    )


def health_score_clamped(raw: Column) -> Column:
    return F.least(F.greatest(raw, F.lit(0)), F.lit(k.SCORE_BASE))


def health_category(raw: Column) -> Column:
    """Category of the score before clamping."""
    result = None
    for lowest, label in k.HEALTH_CATEGORIES:
        result = (F if result is None else result).when(raw >= lowest, label)
    return result.otherwise(k.HEALTH_WORST)


def percent_of_day(minutes: Column) -> Column:
    return F.round(minutes / F.lit(k.MINUTES_PER_DAY) * 100, 1)


def heart_rate_zone(bpm: Column) -> Column:
    """Gauge zone of a heart rate; NULL when missing."""
    return (
        F.when(bpm < k.GAUGE_NORMAL_FROM, "low")
        .when(bpm <= k.GAUGE_NORMAL_TO, "normal")
        .when(bpm > k.GAUGE_NORMAL_TO, "high")
    )
