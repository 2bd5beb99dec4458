"""Dashboard queries and data checks on small marts."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from collarlake.operators import dashboard, quality
from tests.conftest import plan_of, rows

SCHEMA = (
    "daily_summary_id string, cat_id string, cat_name string, breed string, gender string, "
    "age_years int, human_equivalent_age int, weight_lbs double, weight_category string, "
    "reading_date date, avg_heart_rate_bpm double, total_daily_steps bigint, "
    "avg_purr_frequency_hz double, estimated_sleep_minutes bigint, "
    "estimated_active_minutes bigint, estimated_lazy_minutes bigint, "
    "daily_feline_health_score int, health_status_category string"
)
PROFILES = {"C1": ("Tom", "Tabby"), "C2": ("Kit", "Siamese"), None: (None, None)}


def mart(spark, *days):
    """Rows of (cat, day, heart, steps, purr, sleep, score, category)."""
    data = []
    for i, (cat, day, heart, steps, purr, sleep, score, category) in enumerate(days):
        name, breed = PROFILES[cat]
        profile = (cat, name, breed, "male" if cat else None, 3, 28, 8.5, "healthy weight")
        when = None if day is None else date(2026, 5, day)
        data.append((f"id{i}", *profile, when, heart, steps, purr, sleep, 300, 60, score, category))
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def sample(spark):
    return mart(
        spark,
        ("C1", 1, 90.0, 2999, 24.0, 839, 100, "Excellent"),
        ("C1", 3, 181.0, 3002, 25.0, 842, 65, "Needs Attention"),
        ("C2", 2, None, 3000, 24.7, 840, 70, "Good"),
        (None, 5, 120.0, 3002, 26.0, 842, 45, "Critical Care"),
    )


def test_kpis_and_deltas(sample):
    assert rows(dashboard.kpis(sample)) == [(3000, 840, 24.9, 70)]
    assert rows(dashboard.kpi_deltas(sample)) == [(0, 14, 0, 0, -5)]


def test_kpis_of_nothing_are_missing(sample):
    none = dashboard.filter_cat(sample, "nobody")
    assert rows(dashboard.kpis(none)) == [(None,) * 4]
    assert rows(dashboard.has_rows(none)) == [(False,)]
    assert rows(dashboard.has_rows(sample)) == [(True,)]
    assert all(r.share is None for r in dashboard.activity_mix(none).collect())


def test_names_bounds_and_profiles(sample):
    assert rows(dashboard.cat_names(sample)) == [("Kit",), ("Tom",)]
    assert rows(dashboard.date_bounds(sample)) == [(date(2026, 5, 1), date(2026, 5, 5))]
    shown = {r.cat_id: r.gender for r in dashboard.display_profiles(sample).collect()}
    assert shown == {"C1": "Male", "C2": "Male"}


def test_filters_include_both_ends(sample):
    some = dashboard.select_days(sample, date(2026, 5, 1), date(2026, 5, 2))
    assert sorted(r.cat_id for r in some.collect()) == ["C1", "C2"]
    assert dashboard.select_days(sample, last=date(2026, 5, 2), name="Kit").count() == 1
    assert dashboard.select_days(sample, first=date(2026, 5, 3), cat_id="C1").count() == 1
    assert dashboard.filter_cat(sample).count() == 4
    assert dashboard.filter_cat(sample, "Tom").count() == 2
    assert dashboard.filter_cat(sample, cat_id="C2").count() == 1


def test_rows_without_a_date_are_not_selected(spark, sample):
    undated = mart(spark, ("C1", None, 90.0, 9000, 24.0, 839, 100, "Excellent"))
    assert dashboard.select_days(sample.union(undated)).count() == 4
    assert rows(dashboard.date_bounds(undated)) == [(None, None)]


def test_latest(sample):
    latest = {r[0]: r[1:] for r in dashboard.latest_per_cat(sample).collect()}
    assert latest == {
        "C1": (date(2026, 5, 3), 65, "Needs Attention"),
        "C2": (date(2026, 5, 2), 70, "Good"),
    }
    assert rows(dashboard.latest_day(dashboard.filter_cat(sample, "Tom"))) == [
        ("Tom", date(2026, 5, 3), 65, "Needs Attention", 181.0, "high")
    ]
    assert "TakeOrderedAndProject" in plan_of(dashboard.latest_day(sample))


def test_mix_shares_sum_to_one(sample):
    mix = {r.activity: r for r in dashboard.activity_mix(sample).collect()}
    assert set(mix) == {"Sleep", "Active Play", "Lazy Lounging"}
    assert mix["Active Play"].avg_minutes == 300.0
    assert abs(sum(r.share for r in mix.values()) - 1) < 1e-12


def test_tables_are_sorted(sample):
    newest = [r.reading_date.day for r in dashboard.detail_table(sample).collect()]
    oldest = [r.reading_date.day for r in dashboard.step_trend(sample).collect()]
    assert newest == [5, 3, 2, 1] and oldest == [1, 2, 3, 5]
    assert dashboard.detail_table(sample).columns == list(dashboard.DETAIL)


def test_sort_can_split_a_day(sample):
    # The row's own key is part of the range partitioning, so no day is one task's work.
    for df in (dashboard.detail_table(sample), dashboard.step_trend(sample)):
        exchange = plan_of(df).partition("Exchange rangepartitioning")[2].split("\n")[0]
        assert "daily_summary_id" in exchange


def test_sleep_by_breed(sample):
    assert dict(rows(dashboard.sleep_by_breed(sample))) == {
        "Tabby": 840.5, "Siamese": 840.0, None: 842.0,
    }


def test_fact_reports(spark):
    fact = spark.createDataFrame(
        [
            ("r1", "C", datetime(2026, 5, 1, 7), 230, "active", "high/distress"),
            ("r2", "C", datetime(2026, 5, 2, 7), 120, "sleep", "normal"),
            ("r3", "C", datetime(2026, 5, 2, 8), -1, "active", "sensor error"),
        ],
        "reading_id string, cat_id string, reading_time timestamp, heart_rate_bpm int, "
        "activity_level string, cardiac_status string",
    )
    hours = {r[0]: r[1:] for r in dashboard.activity_by_hour(fact).collect()}
    assert hours == {7: (1, 2), 8: (1, 1)}
    odd = dashboard.heart_rate_anomalies(fact)
    assert sorted(r.reading_id for r in odd.collect()) == ["r1", "r3"]


def test_checks_return_what_fails(spark):
    df = spark.createDataFrame(
        [("a", "C", 251), ("a", "C", 250), (None, "X", -2), (None, None, -1), ("b", "X", 0)],
        "reading_id string, cat_id string, heart_rate_bpm int",
    )
    assert quality.null_rows(df, "reading_id").count() == 2
    assert rows(quality.duplicate_values(df, "reading_id")) == [("a", 2)]
    bad = quality.impossible_heart_rates(df)
    assert sorted(r.heart_rate_bpm for r in bad.collect()) == [-2, 251]
    cats = spark.createDataFrame([("C",), (None,)], "cat_id string")
    assert rows(quality.orphan_values(df, cats, "cat_id")) == [("X", 2)]


def test_checks_by_fingerprints(spark):
    """Nulls, repeats, failures and orphans, each in one pass."""
    columns = "reading_id string, cat_id string, heart_rate_bpm int"
    data = [("a", "C", 251), ("a", "C", 250), ("a", "X", 9), (None, "X", -2), (None, None, -1), ("b", "X", 0)]
    df = spark.createDataFrame(data, columns)
    bad = quality._impossible_heart_rate()
    *found, content = quality.unique_check(df, "reading_id", bad)
    assert found == [2, 1, 2] and content.rows == 4
    cats = spark.createDataFrame([("C",), ("C",), (None,)], "cat_id string")
    assert quality.fact_check(df, "reading_id", cats, "cat_id") == (2, 1, 1, content)
    # The content is that of the values, in whatever order, and not of others as many.
    again = spark.createDataFrame(data[::-1], columns)
    assert quality.unique_check(again, "reading_id")[3] == content
    for other in ([("c", "C", 1)] * 4, data[:2] + [("b", "X", 0)] * 2, data[1:]):
        odd = spark.createDataFrame(other, columns)
        assert quality.unique_check(odd, "reading_id")[3] != content
        assert quality.fact_check(odd, "reading_id", cats, "cat_id")[3] != content
    *none, empty = quality.unique_check(df.limit(0), "reading_id", bad)
    assert none == [0, 0, 0] and empty == (0, 0, 0)
    assert quality.fact_check(df.limit(0), "reading_id", cats, "cat_id") == (0, 0, 0, empty)


def test_orphans_are_counted_before_the_join(spark):
    df = spark.createDataFrame([("X",)], "cat_id string")
    plan = plan_of(quality.orphan_values(df, df, "cat_id"))
    join, _, below = plan.partition("LeftAnti")
    assert "HashAggregate" not in join and "HashAggregate" in below


def test_days_longer_than_a_day(spark):
    df = spark.createDataFrame(
        [("a", "C", date(2026, 5, 1), 1440), ("b", "C", date(2026, 5, 1), 1500)],
        "daily_summary_id string, cat_id string, reading_date date, "
        "estimated_sleep_minutes bigint",
    )
    assert [r[0] for r in quality.days_longer_than_a_day(df).collect()] == ["b"]
