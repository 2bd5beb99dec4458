"""Cleaning, deduplication and the registry join."""

from __future__ import annotations

import random
from datetime import date, datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from collarlake.operators.joins import (
    FEWEST_SALTS,
    SALTS,
    broadcast_threshold,
    join_profiles,
    limited,
    salted,
    salts_for,
)
from collarlake.operators.latest import latest_row
from collarlake.plans.silver import clean, dedup_latest, readings_on, silver
from collarlake.schemas import BRONZE
from collarlake.sizing import estimated_bytes
from tests.conftest import plan_of, rows

# As read back from files: the file source makes every column nullable.
STORED = StructType([StructField(field.name, field.dataType) for field in BRONZE])
EARLY, LATE = datetime(2026, 5, 1, 11), datetime(2026, 5, 1, 12)


def bronze(spark, *readings):
    """Rows of (collar, cat, time text, heart, ingested, file)."""
    return spark.createDataFrame(
        [(k, c, t, h, "sleep", 5, 1.0, 20.0, 50, at, f) for k, c, t, h, at, f in readings], STORED
    )


def registry(spark, *cats):
    return spark.createDataFrame([(c, f"name of {c}") for c in cats], "cat_id string, name string")


def kept(df):
    return sorted(rows(df.select("collar_id", "parsed_reading_time", "heart_rate_bpm")), key=str)


def test_latest_ingested_wins(spark):
    t = "2026-05-01 10:00:00"
    df = bronze(spark, ("K1", "C1", t, 100, EARLY, "b"), ("K1", "C1", t, 110, LATE, "a"))
    assert kept(dedup_latest(clean(df))) == [("K1", datetime(2026, 5, 1, 10), 110)]


def test_tie_goes_to_the_greater_file_then_to_the_greater_row(spark):
    t = "2026-05-01 10:00:00"
    df = bronze(
        spark,
        ("K1", "C1", t, 150, LATE, "a"),
        ("K1", "C1", t, 100, LATE, "b"),
        ("K2", "C1", t, 90, LATE, "a"),
        ("K2", "C1", t, 95, LATE, "a"),
    )
    at = datetime(2026, 5, 1, 10)
    for parts in (1, 4):
        found = kept(dedup_latest(clean(df.repartition(parts))))
        assert found == [("K1", at, 100), ("K2", at, 95)]


def test_unparsed_times_of_a_collar_become_one_row(spark):
    df = bronze(
        spark,
        ("K1", "C1", "bad", 100, EARLY, "a"),
        ("K1", "C1", "worse", 120, LATE, "a"),
        ("K2", "C1", "bad", 130, EARLY, "a"),
    )
    assert kept(dedup_latest(clean(df))) == [("K1", None, 120), ("K2", None, 130)]


def test_missing_ingest_time_loses(spark):
    t = "2026-05-01 10:00:00"
    df = bronze(spark, ("K1", "C1", t, 100, None, "z"), ("K1", "C1", t, 110, EARLY, "a"))
    assert [row[2] for row in kept(dedup_latest(clean(df)))] == [110]


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.integers(0, 2) | st.none(),
            st.integers(0, 3) | st.none(),
            st.integers(0, 3) | st.none(),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_latest_row_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, "k1 string, k2 int, o int, v int")

    def rank(value):
        return (value is not None, value or 0)

    best = {}
    for k1, k2, o, v in data:
        if (k1, k2) not in best or (rank(o), rank(v)) > tuple(map(rank, best[k1, k2])):
            best[k1, k2] = (o, v)
    found = {(k1, k2): (o, v) for k1, k2, o, v in rows(latest_row(df, ("k1", "k2"), ("o",)))}
    assert found == best


def test_hot_key_is_reduced_before_the_shuffle(spark):
    plan = plan_of(dedup_latest(clean(bronze(spark, ("K", "C", "bad", 1, EARLY, "a")))))
    before, _, after = plan.partition("Exchange hashpartitioning")
    assert "max(struct" in before and "partial_max(struct" in after
    assert "Window" not in plan


def test_unknown_cat_is_dropped_and_key_appears_once(spark):
    t = "2026-05-01 10:00:00"
    df = bronze(
        spark, ("K1", "C1", t, 100, LATE, "a"), ("K2", "X", t, 100, LATE, "a"),
        ("K3", None, t, 100, LATE, "a"),
    )
    out = silver(df, registry(spark, "C1"))
    assert [(r.collar_id, r.name) for r in out.collect()] == [("K1", "name of C1")]
    assert out.columns.count("cat_id") == 1


def skewed(spark, n=6000):
    """A third of all readings belongs to one cat."""
    pick = random.Random(7)
    cats = ["HOT" if i % 3 == 0 else f"C{pick.randrange(400)}" for i in range(n)]
    data = [(f"K{i}", c, i) for i, c in enumerate(cats)]
    return spark.createDataFrame(data, "collar_id string, cat_id string, v int")


def test_salted_join_equals_plain_join(spark):
    readings = skewed(spark)
    cats = registry(spark, "HOT", "HOT", *(f"C{i}" for i in range(0, 400, 2)))
    plain = readings.join(cats, "cat_id")
    spread = join_profiles(readings, cats, spread_by=("collar_id",), broadcast_limit=0)
    assert spread.columns == plain.columns
    assert sorted(rows(spread)) == sorted(rows(plain))
    assert plan_of(spread).count("_salt") > 0 and "Cartesian" not in plan_of(spread)


def test_no_join_task_gets_the_whole_hot_key(spark):
    left, right = salted(skewed(spark), registry(spark, "HOT", "C1"), ("collar_id",), 40)
    sizes = dict(rows(left.filter("cat_id = 'HOT'").groupBy("_salt").count()))
    assert len(sizes) == 40 and max(sizes.values()) < 100
    assert dict(rows(right.groupBy("cat_id").count())) == {"HOT": 40, "C1": 40}


def test_without_broadcast_readings_are_shuffled_once_and_by_salt(spark):
    """No exchange carries readings by the animal alone, and no job runs to plan the join."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_profiles(skewed(spark), registry(spark, "HOT", "C1"), spread_by=("collar_id",))
        plan = plan_of(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(exchanges) == 2 and all("_salt" in line for line in exchanges)


def test_only_a_registry_known_to_be_small_is_broadcast(spark, tmp_path):
    readings, unknown_size = skewed(spark, 30), registry(spark, "HOT")
    unknown_size.write.parquet(str(tmp_path / "cats"))
    stored = spark.read.parquet(str(tmp_path / "cats"))
    small = join_profiles(readings, stored, spread_by=("collar_id",))
    assert "BroadcastHashJoin" in plan_of(small) and "_salt" not in plan_of(small)
    for cats, limit in ((unknown_size, None), (stored, 0)):
        large = join_profiles(
            readings, cats, spread_by=("collar_id",), broadcast_limit=limit
        )
        assert "_salt" in plan_of(large)


def test_a_repeated_registry_is_not_broadcast(spark, tmp_path):
    """Above the limit by all its columns, below the threshold by those that the query reads."""
    cats = registry(spark, "HOT", *(f"C{i}" for i in range(400)))
    cats.write.parquet(str(tmp_path / "cats"))
    stored = spark.read.parquet(str(tmp_path / "cats"))
    readings = skewed(spark)
    assert estimated_bytes(stored.select("cat_id")) < broadcast_threshold(stored)
    spread = join_profiles(readings, stored, spread_by=("collar_id",), broadcast_limit=0)
    assert "BroadcastHashJoin" in plan_of(readings.join(stored, "cat_id").select("v"))
    ran = spread.select("v")
    assert sorted(rows(ran)) == sorted(rows(readings.select("v")))
    assert "Broadcast" not in plan_of(ran)
    one_each = readings.select("cat_id").distinct()
    assert "Broadcast" not in plan_of(one_each.join(limited(stored, 0), "cat_id", "left"))


def test_profiles_are_repeated_by_their_size_beside_the_readings(spark):
    assert salts_for(10**12, 10**9) == SALTS and salts_for(10**9, 0) == SALTS
    assert salts_for(10**9, 10**9) == salts_for(10**6, 10**9) == FEWEST_SALTS
    assert salts_for(32 * 10**9, 10**9) == 8


def test_silver_is_the_same_with_and_without_salts(spark):
    """Half of the readings are of one cat, and a third have one collar and no valid time."""
    pick = random.Random(3)
    data = []
    for i in range(600):
        time = "bad" if i % 3 == 0 else f"2026-05-01 {i % 24:02d}:00:00"
        collar = "K0" if i % 3 == 0 else f"K{i % 40}"
        cat = "C0" if i % 2 == 0 else f"C{pick.randrange(20)}"
        data.append((collar, cat, time, pick.randrange(30, 260), LATE, f"f{pick.randrange(3)}"))
    df = bronze(spark, *data)
    cats = registry(spark, *(f"C{i}" for i in range(15)))
    plain = dedup_latest(clean(df)).join(cats, "cat_id")
    spread = silver(df, cats, broadcast_limit=0)
    assert "_salt" in plan_of(spread)
    assert spread.columns == plain.columns
    assert sorted(rows(spread), key=str) == sorted(rows(plain), key=str)
    assert spread.filter("parsed_reading_time is null").count() == 1


def test_days_filter_reaches_the_reader(spark, tmp_path):
    df = bronze(
        spark,
        ("K1", "C1", "2026-05-01 10:00:00", 100, LATE, "a"),
        ("K1", "C1", "2026-05-02 23:59:59", 100, LATE, "a"),
        ("K1", "C1", "2026-05-03 00:00:00", 100, LATE, "a"),
        ("K1", "C1", "2026-05-04 00:00:00", 100, EARLY, "a"),
        ("K1", "C1", "bad", 100, LATE, "a"),
    )
    df.write.parquet(str(tmp_path / "bronze"))
    stored = spark.read.parquet(str(tmp_path / "bronze"))
    some = readings_on(stored, [date(2026, 5, 2), date(2026, 5, 4)])
    assert sorted(r.reading_time[:10] for r in some.collect()) == ["2026-05-02", "2026-05-04"]
    assert "GreaterThanOrEqual(reading_time,2026-05-02)" in plan_of(some)
    assert "LessThan(reading_time,2026-05-05)" in plan_of(some)


def test_undated_readings_are_a_day_of_their_own(spark):
    texts = ["2026-05-01 10:00:00", "2026-05-01 99:00:00", "bad", None]
    df = bronze(spark, *(("K1", "C1", t, 100, LATE, "a") for t in texts))

    def found(days):
        return {r.reading_time for r in readings_on(df, days).collect()}

    assert found([date(2026, 5, 1)]) == {texts[0]}
    assert found([None]) == set(texts[1:])
    assert found([None, date(2026, 5, 1)]) == set(texts)
    assert found([]) == set()


def test_sensor_values_are_cleaned(spark):
    df = spark.createDataFrame(
        [("K1", "C1", "2026-05-01 10:00:00", 300, None, -4, None, None, 130, LATE, "a")], STORED
    )
    row = clean(df).first()
    assert (row.heart_rate_bpm, row.steps_count, row.battery_level_pct) == (None, 0, -1)
    assert clean(df).columns == [*BRONZE.names, "parsed_reading_time"]
    assert clean(df).select(F.col("parsed_reading_time")).dtypes[0][1] == "timestamp"
