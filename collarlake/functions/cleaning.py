"""Sensor guard rails and the defaults of the staging models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from collarlake import constants as k


def parse_reading_time(text: Column) -> Column:
    """Text to timestamp; text that does not fit the pattern gives NULL."""
    return F.try_to_timestamp(text, F.lit(k.READING_TIME_PATTERN))


def clean_heart_rate(bpm: Column) -> Column:
    """NULL outside the valid range."""
    return F.when(bpm.between(k.HEART_RATE_MIN, k.HEART_RATE_MAX), bpm)


def clean_battery(pct: Column) -> Column:
    """-1 when missing or outside the valid range."""
    return F.when(pct.between(k.BATTERY_MIN, k.BATTERY_MAX), pct).otherwise(k.MISSING_SENSOR)


def clean_steps(steps: Column) -> Column:
    """0 when missing or negative."""
    return F.when(steps >= 0, steps).otherwise(0)


def default_to(value: Column, default: int | float | str) -> Column:
    return F.coalesce(value, F.lit(default))


def null_tokens(text: Column) -> Column:
    """NULL for any of the tokens that stand for NULL in the registry file."""
    return F.when(~text.isin(*k.CSV_NULL_TOKENS), text)


def initial_capital(text: Column) -> Column:
    """First letter upper case, the rest lower case; later words are not capitalized."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 2_147_483_647)))
