"""The whole chain over files, and rebuilding single days."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from collarlake.operators import dashboard
from collarlake.operators.quality import ChecksFailed
from collarlake.plans import lake
from collarlake.sources import tables
from tests.conftest import plan_of, rows
from tests.test_loads import HEADER
from tests.test_streaming import drop_file

AS_OF = date(2026, 6, 1)


def reading(cat, day, hour, **more):
    return {
        "collar_id": f"K{cat}",
        "cat_id": cat,
        "reading_time": f"2026-05-{day:02d} {hour:02d}:00:00",
        "heart_rate_bpm": 120,
        "activity_level": "sleep",
        "steps_count": 100,
        "purr_frequency_hz": 25.0,
        "ambient_temp_c": 20.0,
        "battery_level_pct": 80,
    } | more


@pytest.fixture
def place(tmp_path):
    (tmp_path / "registry").mkdir()
    (tmp_path / "registry" / "cats.csv").write_text(
        f"{HEADER}\nC1,Tom,Tabby,MALE,2023-02-03,8.5,O1,2024-01-01\n"
        "C2,Kit,NULL,Female,2025-02-03,16,O1,2024-01-01\n"
    )
    landing = tmp_path / "landing"
    drop_file(
        landing,
        "first.json",
        *(reading("C1", day, hour) for day in (1, 2) for hour in range(10)),
        reading("C2", 1, 0, steps_count=499),
        reading("X", 1, 0),
        reading("C1", 1, 0, reading_time="garbage"),
    )
    return lake.Lake(str(tmp_path / "lake"), str(landing), str(tmp_path / "registry"))


def days(df):
    return {(r.cat_id, r.reading_date): r for r in df.collect()}


def files(spark, place, table):
    read = tables.read(spark, place.path(table)).select("reading_date", "_metadata.file_path")
    return {(str(r.reading_date), r.file_path) for r in read.distinct().collect()}


def test_build_and_late_readings(spark, place, tmp_path):
    first = days(lake.run(spark, place, AS_OF))
    assert set(first) == {
        ("C1", date(2026, 5, 1)), ("C1", date(2026, 5, 2)), ("C2", date(2026, 5, 1)), ("C1", None),
    }
    tom = first["C1", date(2026, 5, 1)]
    assert (tom.total_daily_steps, tom.daily_feline_health_score) == (1000, 100)
    kit = first["C2", date(2026, 5, 1)]
    assert (kit.breed, kit.daily_feline_health_score, kit.health_status_category) == (
        "Mixed Breed", 70, "Good",
    )
    before = {name: files(spark, place, name) for name in ("fact_readings", "bi_flat", "silver")}

    # The same reading again with another value, a late one, and one of a day not asked for.
    drop_file(
        tmp_path / "landing",
        "second.json",
        reading("C1", 2, 0, steps_count=150),
        reading("C2", 2, 0),
        reading("C2", 1, 1),
        reading("C2", 2, 0, reading_time="2026-05-02 99:00:00"),
    )
    second = days(lake.run(spark, place, AS_OF, days=[date(2026, 5, 2)]))
    assert second["C1", date(2026, 5, 2)].total_daily_steps == 1050
    assert second["C2", date(2026, 5, 2)].total_daily_steps == 100
    unchanged = [key for key in first if key[1] != date(2026, 5, 2)]
    assert all(second[key] == first[key] for key in unchanged)
    for name, old in before.items():
        new = files(spark, place, name)
        kept = {f for f in old if f[0] != "2026-05-02"}
        assert kept == {f for f in new if f[0] != "2026-05-02"}
        assert not {f for f in old if f[0] == "2026-05-02"} & new

    # Readings without a valid time can be rebuilt on their own.
    undated = days(lake.run(spark, place, AS_OF, days=[None]))
    assert set(undated) == set(second) | {("C2", None)}
    assert all(undated[key] == second[key] for key in second)

    # A full rebuild takes the rest.
    third = days(lake.run(spark, place, AS_OF))
    assert third["C2", date(2026, 5, 1)].total_daily_steps == 599
    report = {r.check: r.failures for r in lake.check(spark, place).collect()}
    warned = {name: n for name, n in report.items() if name.startswith("warning")}
    assert not any(n for name, n in report.items() if name not in warned)
    assert warned["warning: reading_time parsed"] > 0


def test_rebuilt_days_without_rows_are_removed(spark, place, tmp_path):
    """An animal leaves the registry: its only day goes, and the checks pass."""
    lake.run(spark, place, AS_OF)
    (tmp_path / "registry" / "cats.csv").write_text(
        "\n".join(
            line
            for line in (tmp_path / "registry" / "cats.csv").read_text().splitlines()
            if not line.startswith("C2")
        )
        + "\n"
    )
    mart = lake.run(spark, place, AS_OF, days=[date(2026, 5, 1), date(2026, 5, 2)])
    assert mart.where("cat_id = 'C2'").count() == 0
    for table in ("silver", "staging_telemetry", "fact_readings"):
        assert lake.read(spark, place, table).where("cat_id = 'C2'").count() == 0


def everything(spark, place):
    """The marts' rows, whatever files they are in."""
    names = ("dim_cats", "fact_readings", "daily_health", "bi_flat")
    return {name: sorted(map(str, lake.read(spark, place, name).collect())) for name in names}


def fresh(spark, place, tmp_path, name):
    """The marts of another lake that is built at once from the same files."""
    other = replace(place, root=str(tmp_path / name))
    lake.run(spark, other, AS_OF)
    return everything(spark, other)


def test_a_run_finds_the_days_that_changed(spark, place, tmp_path):
    lake.run(spark, place, AS_OF)
    assert lake.days_to_build(spark, place, AS_OF) == set()
    before = {name: files(spark, place, name) for name in ("fact_readings", "bi_flat", "silver")}
    drop_file(
        tmp_path / "landing",
        "late.json",
        reading("C1", 2, 0, steps_count=150),
        reading("C2", 2, 0),
        reading("C2", 9, 0),
        reading("C2", 2, 0, reading_time="2026-05-02 99:00:00"),
    )
    lake.build_bronze(spark, place)
    assert lake.days_to_build(spark, place, AS_OF) == {date(2026, 5, 2), date(2026, 5, 9), None}
    lake.run(spark, place, AS_OF)
    assert everything(spark, place) == fresh(spark, place, tmp_path, "other")
    for name, old in before.items():
        assert {f for f in old if f[0] == "2026-05-01"} <= files(spark, place, name)
    history = [tuple(r) for r in lake.load_history(spark, place).sort("load_id").select("table_name", "rows_loaded").collect()]
    # Of 2 May 10 + 1 readings, one of 9 May, and the two without a valid time.
    assert history[2:] == [("staging_telemetry", 14), ("staging_registry", 0)] or history[2:] == [
        ("staging_registry", 0), ("staging_telemetry", 14),
    ]


def test_a_run_over_named_days_leaves_the_rest_to_the_next(spark, place, tmp_path):
    lake.run(spark, place, AS_OF)
    drop_file(tmp_path / "landing", "late.json", reading("C2", 1, 5), reading("C2", 2, 5))
    lake.run(spark, place, AS_OF, days=[date(2026, 5, 2)])
    assert lake.days_to_build(spark, place, AS_OF) == {date(2026, 5, 1), date(2026, 5, 2)}
    lake.run(spark, place, AS_OF)
    assert everything(spark, place) == fresh(spark, place, tmp_path, "other")


def test_a_registry_that_changes_reaches_all_days(spark, place, tmp_path):
    """One animal gets another weight, one leaves, one comes whose readings were dropped."""
    lake.run(spark, place, AS_OF)
    before = files(spark, place, "fact_readings")
    cats = tmp_path / "registry" / "cats.csv"
    cats.write_text(
        f"{HEADER}\nC1,Tom,Tabby,MALE,2023-02-03,14.5,O1,2024-01-01\n"
        "C2,Kit,NULL,Female,2025-02-03,16,O1,2024-01-01\n"
    )
    drop_file(tmp_path / "landing", "new.json", reading("C1", 9, 0))
    mart = lake.run(spark, place, AS_OF)
    assert {r.weight_category for r in mart.where("cat_id = 'C1'").collect()} == {"overweight"}
    assert everything(spark, place) == fresh(spark, place, tmp_path, "second")
    assert before < files(spark, place, "fact_readings")  # readings of other days were not touched

    cats.write_text(
        f"{HEADER}\nC1,Tom,Tabby,MALE,2023-02-03,14.5,O1,2024-01-01\n"
        "X,Max,Tabby,male,2022-02-03,7,O1,2024-01-01\n"
    )
    lake.build_bronze(spark, place)
    assert lake.days_to_build(spark, place, AS_OF) == {date(2026, 5, 1)}
    lake.run(spark, place, AS_OF)
    assert everything(spark, place) == fresh(spark, place, tmp_path, "third")


def test_days_of_older_schemas_are_read_together(spark, place, tmp_path):
    """The registry gains a column; days that are not rebuilt stay as they are."""
    lake.run(spark, place, AS_OF)
    before = {f for f in files(spark, place, "silver") if f[0] != "2026-05-02"}
    (tmp_path / "registry" / "cats.csv").write_text(
        f"{HEADER},colour\nC1,Tom,Tabby,MALE,2023-02-03,8.5,O1,2024-01-01,grey\n"
        "C2,Kit,NULL,Female,2025-02-03,16,O1,2024-01-01,red\n"
    )
    lake.run(spark, place, AS_OF, days=[date(2026, 5, 2)])
    assert before == {f for f in files(spark, place, "silver") if f[0] != "2026-05-02"}
    colours = {r.reading_date: r.colour for r in lake.read_silver(spark, place).collect()}
    assert colours == {date(2026, 5, 1): None, date(2026, 5, 2): "grey", None: None}
    assert lake.read_silver(spark, place).count() == lake.read(spark, place, "silver").count() == 22
    one = lake.read_silver(spark, place, [date(2026, 5, 1)])
    assert "colour" not in one.columns and one.count() == 11
    assert lake.read_silver(spark, place, [date(2030, 1, 1)]).count() == 0


def test_types_take_in_narrower_ones():
    for types, common in (
        (["int"], "int"), (["bigint", "int"], "bigint"), (["int", "double"], "double"),
        (["float", "double"], "double"), (["date", "timestamp"], "timestamp"),
        (["bigint", "double"], "string"), (["boolean", "int"], "string"),
    ):
        assert tables.common_type(types) == common


def test_a_lost_mark_means_a_full_build(spark, place, tmp_path):
    lake.run(spark, place, AS_OF)
    tables.remove(spark, place.path("progress"))
    assert lake.days_to_build(spark, place, AS_OF) is None
    lake.run(spark, place, AS_OF)
    assert lake.days_to_build(spark, place, AS_OF) == set()


def test_a_damaged_file_is_left_out_and_named(spark, place, tmp_path):
    lake.run(spark, place, AS_OF)
    day = tmp_path / "lake" / "silver" / "reading_date=2026-05-02"
    good = next(day.glob("part-*.parquet"))
    (day / "part-cut.snappy.parquet").write_bytes(good.read_bytes()[:-100])
    lake.build_staging(spark, place)
    (row,) = lake.skipped_files(spark, place).collect()
    assert row.path.endswith("reading_date=2026-05-02/part-cut.snappy.parquet")
    assert (row.skipped, row.reading_date) == ("no mark at its end", date(2026, 5, 2))
    assert lake.read(spark, place, "staging_telemetry").count() == 22
    last = lake.load_history(spark, place).sort(F.desc("load_id")).where("table_name = 'staging_telemetry'").first()
    assert (last.rows_loaded, last.files_loaded, last.files_skipped) == (10, 1, 1)
    # The load does not look at it again; one that may not leave files out fails.
    lake.build_staging(spark, place)
    assert lake.skipped_files(spark, place).count() == 1
    (day / "part-cut2.snappy.parquet").write_bytes(good.read_bytes()[:-100])
    with pytest.raises(Exception, match="part-cut"):
        lake.build_staging(spark, replace(place, skip_bad_files=False))
    assert lake.read(spark, place, "staging_telemetry").count() == 22


def test_a_file_is_loaded_once(spark, place, tmp_path):
    lake.run(spark, place, AS_OF)
    before = files(spark, place, "staging_telemetry")
    lake.build_staging(spark, place)
    assert files(spark, place, "staging_telemetry") == before
    # A file that is replaced takes its old rows with it.
    drop_file(tmp_path / "landing", "more.json", reading("C1", 2, 0, steps_count=7), reading("C1", 2, 20))
    lake.build_bronze(spark, place)
    lake.build_silver(spark, place, [date(2026, 5, 2)])
    lake.build_staging(spark, place)
    after = files(spark, place, "staging_telemetry")
    assert {f for f in before if f[0] != "2026-05-02"} == {f for f in after if f[0] != "2026-05-02"}
    staged = lake.read(spark, place, "staging_telemetry").where("reading_date = '2026-05-02'")
    assert staged.count() == 11 and staged.where("steps_count = 7").count() == 1
    # Without the table itself nothing counts as loaded.
    tables.remove(spark, place.path("staging_telemetry"))
    lake.build_staging(spark, place)
    assert lake.read(spark, place, "staging_telemetry").count() == 23


def test_a_write_that_fails_leaves_the_old_days(spark, tmp_path):
    path, day = str(tmp_path / "t"), date(2026, 5, 1)
    old = spark.range(3).withColumn("reading_date", F.lit(day))
    tables.overwrite_by_day(old, path, "reading_date")
    bad = old.withColumn("id", F.raise_error(F.concat(F.lit("no "), "id")).cast("long"))
    with pytest.raises(Exception, match="no "):
        tables.overwrite_by_day(bad, path, "reading_date", days=[day])
    assert tables.read(spark, path).count() == 3
    tables.overwrite_by_day(old.limit(0), path, "reading_date", days=[day])
    assert tables.read(spark, path, old.schema).count() == 0


def test_rejected_rows_of_other_days_stay(spark, place, tmp_path):
    long = "K" * 60
    for day in (1, 2):
        drop_file(tmp_path / "landing", f"long{day}.json", {**reading("C1", day, 3), "collar_id": long})
    lake.run(spark, place, AS_OF)
    assert lake.read(spark, place, "rejected_telemetry").count() == 2
    lake.run(spark, place, AS_OF, days=[date(2026, 5, 2)])
    lake.run(spark, place, AS_OF, days=[date(2026, 5, 9)])
    assert lake.read(spark, place, "rejected_telemetry").count() == 2


@pytest.mark.parametrize("content", ["nothing", "undated", "unregistered"])
def test_empty_inputs(spark, place, tmp_path, content):
    for file in (tmp_path / "landing").glob("*.json"):
        lines = {
            "nothing": "",
            "undated": json.dumps(reading("C1", 1, 0, reading_time="bad")) + "\n",
            "unregistered": json.dumps(reading("C99", 1, 0)) + "\n",
        }
        file.write_text(lines[content])
    for part in (None, [date(2026, 5, 1)], None):
        mart = lake.run(spark, place, AS_OF, days=part)
    assert mart.count() == (1 if content == "undated" else 0)
    lake.register(spark, place)
    audit = {r.table_name: r.row_count for r in lake.audit(spark, place, "staging").collect()}
    assert set(audit) == {"staging_telemetry", "rejected_telemetry", "staging_registry"}
    assert audit["staging_telemetry"] == mart.count() and audit["staging_registry"] == 2
    assert lake.audit(spark, place, "none").count() == 0


def test_archived_files_leave_the_landing_folder(spark, place, tmp_path):
    (tmp_path / "archive").mkdir()
    moved = replace(place, archive=str(tmp_path / "archive"))
    lake.run(spark, moved, AS_OF)
    for n in range(3):
        drop_file(tmp_path / "landing", f"more{n}.json", reading("C1", 2, 5 + n))
        lake.build_bronze(spark, moved)
    assert list((tmp_path / "archive").rglob("*.json"))


def test_a_repeated_cat_fails_the_checks(spark, place, tmp_path):
    with (tmp_path / "registry" / "cats.csv").open("a") as f:
        f.write("C1,Tom again,Tabby,MALE,2023-02-03,8.5,O1,2024-01-01\n")
    with pytest.raises(ChecksFailed) as failed:
        lake.run(spark, place, AS_OF)
    for text in ("staging_registry: unique cat_id: 1", "dim_cats: unique cat_id: 1"):
        assert text in str(failed.value)


def test_days_are_read_by_folder(spark, place):
    lake.run(spark, place, AS_OF)
    some = tables.on_days(tables.read(spark, place.path("bi_flat")), [date(2026, 5, 2)])
    assert "reading_date" in plan_of(some).partition("PartitionFilters: [")[2].partition("]")[0]
    assert [r.reading_date for r in some.collect()] == [date(2026, 5, 2)]
    staged = lake.staged_readings(spark, place, [date(2026, 5, 2)])
    assert {r.reading_time for r in staged.collect()} == {
        datetime(2026, 5, 2, h) for h in range(10)
    }


def test_tables_and_views_can_be_used_in_sql(spark, place):
    lake.run(spark, place, AS_OF)
    lake.register(spark, place)
    steps = spark.sql(
        "select d.total_daily_steps, b.cat_name from daily_telemetry d "
        "join bi_flat b using (daily_summary_id) where d.reading_date = date '2026-05-02'"
    )
    assert rows(steps) == [(1000, "Tom")]
    counts = {
        name: spark.table(name).count() for name in (*lake.TABLES, "stg_telemetry", "stg_registry")
    }
    assert counts["bronze"] == 23 and counts["silver"] == counts["stg_telemetry"] == 22
    assert counts["dim_cats"] == counts["stg_registry"] == 2


def test_a_large_day_is_split_over_files_and_small_days_are_not(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    day = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 20)
    df = spark.range(300_000, numPartitions=16).select(
        F.date_add(F.lit(date(2026, 5, 1)), day.cast("int")).alias("reading_date"),
        F.md5(F.col("id").cast("string")).alias("text"),
    )
    spark.conf.set(size, "1m")
    try:
        tables.overwrite_by_day(df, str(tmp_path / "t"), "reading_date")
    finally:
        spark.conf.set(size, before)
    written = tables.read(spark, str(tmp_path / "t"))
    files_of = dict(
        rows(written.groupBy("reading_date").agg(F.count_distinct("_metadata.file_path")))
    )
    assert written.count() == 300_000
    assert files_of.pop(date(2026, 5, 1)) >= 3
    # A file per task and day would be 16 each. A day hashed to the large day's partition
    # is split along with it.
    assert sum(files_of.values()) < 2 * len(files_of)


def scanned_rows(df):
    """Rows that left the scan of a query that was run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value(), leaf.metrics().get("numFiles").get().value()


def test_one_animal_is_read_without_the_others(spark, tmp_path):
    """Files hold ranges of animals, and rows in them are in order."""
    df = spark.range(200_000, numPartitions=8).select(
        F.concat(F.lit("C"), F.lpad((F.col("id") % 10_000).cast("string"), 5, "0")).alias("cat_id"),
        F.concat(F.lit("Cat "), F.col("id") % 5_000).alias("cat_name"),
        F.date_add(F.lit(date(2026, 5, 1)), (F.col("id") % 2).cast("int")).alias("reading_date"),
        F.md5(F.col("id").cast("string")).alias("text"),
    )
    paths = str(tmp_path / "mixed"), str(tmp_path / "ordered")
    with_small_groups = {"parquet.block.size": "100000"}
    hadoop = spark._jsc.hadoopConfiguration()
    for name, value in with_small_groups.items():
        hadoop.set(name, value)
    try:
        tables.overwrite_by_day(df, paths[0], "reading_date")
        tables.overwrite_by_day(df, paths[1], "reading_date", cluster="cat_id")
    finally:
        for name in with_small_groups:
            hadoop.unset(name)
    found = {}
    for path in paths:
        mart = tables.read(spark, path)
        one = dashboard.filter_cat(mart, cat_id="C00042")
        assert sorted(map(str, one.collect())) == sorted(map(str, df.where("cat_id = 'C00042'").select(*mart.columns).collect()))
        found[path], files_read = scanned_rows(one)
        cats = df.select("cat_id", "cat_name").distinct()
        named = dashboard.filter_named(mart, cats, "Cat 42")
        assert named.select("cat_id").distinct().count() == 2 and named.count() == 40
    assert found[paths[1]] < 10_000 < 5 * found[paths[1]] + 50_000 < found[paths[0]]
