"""Each rule at its boundaries."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from collarlake.functions import cleaning, health, numbers, profile
from collarlake.functions.keys import surrogate_key
from tests.conftest import column, rows

x = "x"


def applied(spark, expression, values, kind):
    # One file per call keeps the order of the values.
    df = spark.createDataFrame([(v,) for v in values], f"{x} {kind}").coalesce(1)
    return column(df.select(expression(F.col(x))))


CASES = [
    (cleaning.clean_heart_rate, "int", [39, 40, 250, 251, None], [None, 40, 250, None, None]),
    (cleaning.clean_battery, "int", [-1, 0, 100, 101, None], [-1, 0, 100, -1, -1]),
    (cleaning.clean_steps, "int", [-1, 0, 7, None], [0, 0, 7, 0]),
    (
        cleaning.parse_reading_time,
        "string",
        ["2026-05-01 10:00:00", "bad", "", "2026-13-01 10:00:00", "2026-05-01", None],
        [datetime(2026, 5, 1, 10), None, None, None, None, None],
    ),
    (cleaning.null_tokens, "string", ["NULL", "null", "", "Null", " "], [None] * 3 + ["Null", " "]),
    (
        cleaning.initial_capital,
        "string",
        ["female", "MALE", "not known", "", None],
        ["Female", "Male", "Not known", "", None],
    ),
    (profile.human_equivalent_age, "int", [0, 1, 2, 3, 12, -1, None], [0, 15, 24, 28, 64, 12, None]),
    (
        profile.weight_category,
        "double",
        [6.4, 6.5, 11.5, 11.6, 15.0, 15.1, None],
        ["underweight", "healthy weight", "healthy weight", "overweight", "overweight", "obese"]
        + ["obese"],
    ),
    (health.low_battery_warning, "int", [15, 16, -1, None], [True, False, True, False]),
    (
        health.cardiac_status,
        "int",
        [221, 220, 90, 89, 1, 0, -1, -2, None],
        ["high/distress", "normal", "normal", "bradycardia/low", "bradycardia/low", "normal"]
        + ["sensor error", "normal", "normal"],
    ),
    (health.health_score_clamped, "int", [-5, 0, 45, 100, 120], [0, 0, 45, 100, 100]),
    (
        health.health_category,
        "int",
        [100, 85, 84, 70, 69, 50, 49],
        ["Excellent", "Excellent", "Good", "Good", "Needs Attention", "Needs Attention"]
        + ["Critical Care"],
    ),
    (health.percent_of_day, "bigint", [480, 540, 0, 1440, 60], [33.3, 37.5, 0.0, 100.0, 4.2]),
    (
        health.heart_rate_zone,
        "double",
        [99.9, 100.0, 180.0, 180.1, None],
        ["low", "normal", "normal", "high", None],
    ),
]


@pytest.mark.parametrize(("function", "kind", "given_", "expected"), CASES)
def test_rule(spark, function, kind, given_, expected):
    assert applied(spark, function, given_, kind) == expected


def test_age_counts_calendar_years(spark):
    born = [date(2024, 1, 1), date(2023, 12, 31), date(2025, 6, 1), None]
    ages = applied(spark, lambda c: profile.age_years(c, F.lit(date(2024, 1, 1))), born, "date")
    assert ages == [0, 1, -1, None]


def test_age_refers_to_today_unless_told(spark):
    df = spark.range(1).select(
        profile.age_years(F.current_date(), profile.as_of_date(None)).alias("age")
    )
    assert column(df) == [0]


SCORES = [
    # heart, sleep, steps, battery, score
    (None, 480, 500, 10, 100),
    (79.9, 420, 499, 9, 45),
    (200.0, 1140, 500, 10, 85),
    (200.1, 480, 500, 10, 80),
    (80.0, 1100, 500, None, 100),
    (120.0, 480, 500, -1, 95),
]


def test_health_score(spark):
    df = spark.createDataFrame(SCORES, "h double, s bigint, t bigint, b int, score int").coalesce(1)
    raw = health.health_score_raw(F.col("h"), F.col("s"), F.col("t"), F.col("b"))
    assert column(df.select(raw)) == [case[-1] for case in SCORES]


def test_surrogate_key_text(spark):
    df = spark.createDataFrame(
        [("K1", datetime(2026, 5, 1, 10)), (None, None)], "id string, at timestamp"
    ).coalesce(1)
    token = "_dbt_utils_surrogate_key_null_"
    expected = df.select(
        F.md5(F.lit("K1-2026-05-01 10:00:00.000").cast("binary")).alias("a"),
        F.md5(F.lit(f"{token}-{token}").cast("binary")).alias("b"),
    ).first()
    assert column(df.select(surrogate_key(df, "id", "at"))) == [expected.a, expected.b]


def test_key_of_a_date(spark):
    df = spark.createDataFrame([("C1", date(2026, 5, 1))], "id string, day date")
    expected = spark.range(1).select(F.md5(F.lit("C1-2026-05-01").cast("binary")))
    assert column(df.select(surrogate_key(df, "id", "day"))) == column(expected)


def test_rounding_drops_sum_noise_and_keeps_huge_values(spark):
    values = [2.005, 2.0049999999999994, 1e300, math.inf, -2.345, None]
    got = applied(spark, lambda c: numbers.round_half_up(c, 2), values, "double")
    assert got == [2.01, 2.01, 1e300, math.inf, -2.35, None]


def test_half_even_matches_frames(spark):
    got = applied(spark, lambda c: numbers.round_half_even(c, 1), [0.25, 0.35, 24.86], "double")
    assert got == [0.2, 0.4, 24.9]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.decimals(-10_000, 10_000, places=6), min_size=1, max_size=200))
def test_round_half_up_equals_decimal(spark, exact):
    got = applied(
        spark, lambda c: numbers.round_half_up(c, 2), [float(v) for v in exact], "double"
    )
    assert got == [float(v.quantize(Decimal("0.01"), ROUND_HALF_UP)) for v in exact]


def test_average_does_not_depend_on_the_split(spark):
    df = spark.range(10_000).select((F.col("id") % 1000 / 7).alias("v"))
    results = {
        rows(df.repartition(n).agg(numbers.round_half_up(F.avg("v"), 2)))[0] for n in (1, 7, 64)
    }
    assert len(results) == 1
