"""Typed loads of the registry and of silver files."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from collarlake.schemas import STAGING_REGISTRY, STAGING_TELEMETRY
from collarlake.sources import loads, tables
from collarlake.sources.registry import load_registry, read_registry_csv
from collarlake.sources.telemetry import load_telemetry
from tests.conftest import rows

HEADER = "cat_id,name,breed,gender,birth_date,weight_lbs,owner_id,registered_at"


def csv_file(tmp_path, *lines, header=HEADER):
    path = tmp_path / "registry"
    path.mkdir()
    (path / "part.csv").write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_registry_is_typed(spark, tmp_path):
    path = csv_file(tmp_path, "C1, Tom ,Tabby,MALE,2020-02-03,8.5,O1,2021-01-01")
    out = load_registry(spark, path)
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in STAGING_REGISTRY
    ]
    assert rows(out) == [
        ("C1", " Tom ", "Tabby", "MALE", date(2020, 2, 3), 8.5, "O1", date(2021, 1, 1))
    ]


def test_null_tokens(spark, tmp_path):
    path = csv_file(tmp_path, "C1,NULL,null,,NULL,null,,NULL")
    assert rows(load_registry(spark, path)) == [("C1", *[None] * 7)]


def test_short_and_long_lines_pass(spark, tmp_path):
    path = csv_file(tmp_path, "C1,Tom", "C2,Kit,Tabby,male,2020-02-03,8.5,O1,2021-01-01,extra")
    assert [(r.cat_id, r.owner_id) for r in load_registry(spark, path).collect()] == [
        ("C1", None), ("C2", "O1"),
    ]


@pytest.mark.parametrize(
    "line",
    [
        "C1,Tom,Tabby,male,not a day,8.5,O1,2021-01-01",
        "C1,Tom,Tabby,male,2020-02-03,heavy,O1,2021-01-01",
        f"{'C' * 51},Tom,Tabby,male,2020-02-03,8.5,O1,2021-01-01",
    ],
)
def test_a_bad_value_aborts_the_load(spark, tmp_path, line):
    path = csv_file(tmp_path, "C0,Kit,Tabby,male,2020-02-03,8.5,O1,2021-01-01", line)
    with pytest.raises(Exception, match="registry load: bad"):
        tables.overwrite(load_registry(spark, path), str(tmp_path / "out"))


def test_load_is_by_position_and_silver_read_is_by_header(spark, tmp_path):
    path = csv_file(tmp_path, "Tom,C1", header="name,cat_id")
    assert rows(read_registry_csv(spark, path).select("cat_id", "name")) == [("C1", "Tom")]
    assert rows(load_registry(spark, path).select("cat_id", "name")) == [("Tom", "C1")]


def silver_files(spark, path, **changes):
    df = spark.range(3).select(
        F.concat(F.lit("K"), "id").alias("collar_id"),
        F.lit("C").alias("cat_id"),
        F.lit("2026-05-01 10:00:00").alias("reading_time"),
        F.lit(datetime(2026, 5, 1, 10)).alias("parsed_reading_time"),
        F.lit("100").alias("heart_rate_bpm"),
        F.lit("lazy").alias("activity_level"),
        F.lit(5).alias("steps_count"),
        F.lit(1.5).alias("purr_frequency_hz"),
        F.lit(20.0).alias("ambient_temp_c"),
        F.lit(50).alias("battery_level_pct"),
        F.lit(datetime(2000, 1, 1)).alias("ingested_at"),
        F.lit("landing/old.json").alias("source_file"),
        F.lit("Tom").alias("name"),
    )
    for name, change in changes.items():
        df = df.drop(name) if change is None else df.withColumn(name, change)
    df.write.parquet(str(path))
    return load_telemetry(spark, str(path))


def test_rejected_rows_are_counted_on_the_way(spark, tmp_path):
    silver_files(spark, tmp_path / "s", heart_rate_bpm=F.concat(F.lit("1"), "collar_id"))
    counts = Observation()
    load = load_telemetry(spark, str(tmp_path / "s"), counts=counts)
    tables.overwrite(load.loaded, str(tmp_path / "out"))
    assert counts.get["rejected"] == 3
    assert tables.read(spark, str(tmp_path / "out")).count() == 0


def test_load_has_the_staging_schema_and_new_audit_values(spark, tmp_path):
    load = silver_files(spark, tmp_path / "s")
    assert [(f.name, f.dataType) for f in load.loaded.schema] == [
        (f.name, f.dataType) for f in STAGING_TELEMETRY
    ]
    row = load.loaded.first()
    assert row.reading_time == datetime(2026, 5, 1, 10) and row.heart_rate_bpm == 100
    assert row.ingested_at.year > 2000 and row.source_file.endswith(".parquet")
    assert load.loaded.count() == 3 and load.rejected.isEmpty()


def test_rows_that_do_not_fit_are_set_apart(spark, tmp_path):
    one, two = F.col("id") == 1, F.col("id") == 2
    load = silver_files(
        spark,
        tmp_path / "s",
        id=F.substring("collar_id", 2, 1).cast("int"),
        heart_rate_bpm=F.when(one, "fast").otherwise("100"),
        activity_level=F.when(one | two, F.repeat(F.lit("z"), F.lit(31))).otherwise("lazy"),
    )
    assert [r.collar_id for r in load.loaded.collect()] == ["K0"]
    assert {r.collar_id: r.bad_columns for r in load.rejected.collect()} == {
        "K1": ["heart_rate_bpm", "activity_level"],
        "K2": ["activity_level"],
    }


def test_a_missing_column_is_null(spark, tmp_path):
    load = silver_files(spark, tmp_path / "s", purr_frequency_hz=None)
    assert {r.purr_frequency_hz for r in load.loaded.collect()} == {None}


def test_an_unreadable_file_is_left_out_only_if_named(spark, tmp_path):
    silver_files(spark, tmp_path / "s")
    (tmp_path / "s" / "part-broken.snappy.parquet").write_bytes(b"PAR1 not parquet PAR1")
    path = str(tmp_path / "s")
    schema = spark.read.parquet(str(next((tmp_path / "s").glob("part-0*.parquet")))).schema
    bad = loads.bad_files(spark, path, schema)
    assert [(p.rpartition("/")[2], why) for p, why in bad] == [
        ("part-broken.snappy.parquet", "footer longer than the file")
    ]
    load = load_telemetry(spark, path, skip=[p for p, _ in bad], schema=schema)
    assert load.loaded.count() == 3
    with pytest.raises(Exception, match="part-broken"):
        load_telemetry(spark, path, schema=schema).loaded.collect()


def test_audit_counts_rows(spark, tmp_path):
    paths = {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")}
    tables.overwrite(spark.range(5), paths["a"])
    tables.overwrite(spark.range(0), paths["b"])
    audit = {r.table_name: r for r in tables.load_audit(spark, paths).collect()}
    assert {name: r.row_count for name, r in audit.items()} == {"a": 5, "b": 0}
    assert audit["a"].last_altered is not None
