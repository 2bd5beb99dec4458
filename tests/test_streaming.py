"""Streaming ingest into bronze."""

from __future__ import annotations

import json
import os
import re
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from collarlake.schemas import BRONZE, RAW_TELEMETRY
from collarlake.sources.telemetry import read_bronze
from collarlake.streaming.bronze import (
    batches,
    compact,
    days_of_batches,
    ingest,
    read_landing,
    read_log,
    read_quarantine,
    start_bronze,
    with_ingest_audit,
    write_batch,
)
from collarlake.streaming import bronze as module
from collarlake.workspace import scratch_dir
from tests.conftest import plan_of


def drop_file(folder, name, *readings):
    folder.mkdir(exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in readings]
    (folder / name).write_text("\n".join(lines) + "\n")


def reading(collar, **more):
    return {"collar_id": collar, "cat_id": "C", "reading_time": "2026-05-01 10:00:00", **more}


def places(tmp_path):
    return tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "checkpoint")


def test_each_file_is_ingested_once(spark, tmp_path):
    landing, bronze, checkpoint = places(tmp_path)
    drop_file(landing, "a.json", reading("K1", heart_rate_bpm=100), reading("K1"))
    ingest(spark, str(landing), bronze, checkpoint)
    ingest(spark, str(landing), bronze, checkpoint)
    assert read_bronze(spark, bronze).count() == 2
    drop_file(landing, "b.json", reading("K2"))
    ingest(spark, str(landing), bronze, checkpoint)
    out = read_bronze(spark, bronze)
    assert sorted(r.collar_id for r in out.collect()) == ["K1", "K1", "K2"]


def test_audit_columns(spark, tmp_path):
    landing, bronze, checkpoint = places(tmp_path)
    drop_file(landing, "a.json", reading("K1"))
    drop_file(landing, "b.json", reading("K2"))
    ingest(spark, str(landing), bronze, checkpoint)
    out = read_bronze(spark, bronze)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in BRONZE]
    found = {r.collar_id: r for r in out.collect()}
    assert found["K1"].source_file.endswith("/landing/a.json")
    assert found["K2"].source_file.endswith("/landing/b.json")
    assert len({r.ingested_at for r in found.values()}) == 1


def test_backlog_is_read_in_bounded_batches(spark, tmp_path):
    landing, bronze, checkpoint = places(tmp_path)
    for i in range(4):
        drop_file(landing, f"{i}.json", reading(f"K{i}"))
    ingest(spark, str(landing), bronze, checkpoint, max_files_per_batch=2)
    out = read_bronze(spark, bronze)
    assert out.count() == 4 and out.select("ingested_at").distinct().count() == 2


def test_the_schema_is_fixed(spark, tmp_path):
    landing, bronze, checkpoint = places(tmp_path)
    drop_file(landing, "a.json", reading("K1", steps_count="many", colour="black"), "{broken")
    ingest(spark, str(landing), bronze, checkpoint)
    out = {r.collar_id: r for r in read_bronze(spark, bronze).collect()}
    assert set(out) == {"K1", None}
    assert out["K1"].steps_count is None
    assert all(out[None][name] is None for name in RAW_TELEMETRY.names)


def test_lines_that_cannot_be_read_are_kept_with_their_text(spark, tmp_path):
    landing, bronze, checkpoint = places(tmp_path)
    drop_file(landing, "a.json", reading("K1"), reading("K2", steps_count="many", colour="black"))
    drop_file(landing, "b.json", '{"collar_id": "K3"', "no json", reading("K4", heart_rate_bpm=[1]))
    ingest(spark, str(landing), bronze, checkpoint)
    assert read_bronze(spark, bronze).count() == 5
    found = {r.line: r for r in read_quarantine(spark, bronze).collect()}
    assert {r.reason for r in found.values()} == {"broken", "mistyped"}
    cut = found['{"collar_id": "K3"']
    assert (cut.reason, cut.bad_columns) == ("broken", None)
    assert cut.source_file.endswith("b.json") and cut.ingested_at is not None
    assert found["no json"].reason == "broken"
    bad = {tuple(r.bad_columns) for r in found.values() if r.reason == "mistyped"}
    assert bad == {("steps_count",), ("heart_rate_bpm",)} and len(found) == 4
    # Batches without such lines add nothing.
    drop_file(landing, "c.json", reading("K5"))
    ingest(spark, str(landing), bronze, checkpoint)
    assert read_quarantine(spark, bronze).count() == 4


def test_no_quarantine_without_broken_lines(spark, tmp_path):
    landing, bronze, checkpoint = places(tmp_path)
    drop_file(landing, "a.json", reading("K1"))
    ingest(spark, str(landing), bronze, checkpoint)
    assert read_quarantine(spark, bronze).collect() == []


def test_the_log_names_the_days_of_each_batch(spark, tmp_path):
    landing, bronze, checkpoint = places(tmp_path)
    for name, times in (
        ("a", ["2026-05-01 10:00:00", "2026-05-03 10:00:00"]),
        ("b", ["2026-05-03 11:00:00", "bad"]),
        ("c", []),
    ):
        drop_file(landing, f"{name}.json", *(reading("K", reading_time=t) for t in times))
        ingest(spark, str(landing), bronze, checkpoint)
    first, third = date(2026, 5, 1), date(2026, 5, 3)
    assert batches(spark, bronze) == [0, 1, 2] and batches(spark, bronze, 1) == [2]
    assert days_of_batches(spark, bronze) == {first, third, None}
    assert days_of_batches(spark, bronze, 0) == {third, None}
    assert days_of_batches(spark, bronze, 1) == days_of_batches(spark, bronze, 2) == set()
    log = {r.ingest_batch: (r.n_rows, r.n_quarantined) for r in read_log(spark, bronze).collect()}
    assert log == {0: (2, 0), 1: (2, 0), 2: (0, 0)}


def test_a_batch_adds_few_files_to_a_day(spark, tmp_path):
    """However many files and tasks it came in."""
    landing, bronze, checkpoint = places(tmp_path)
    for n in range(16):
        times = (f"2026-05-{day:02d} {n:02d}:00:00" for day in range(1, 11))
        drop_file(landing, f"{n}.json", *(reading("K", reading_time=t) for t in times))
    ingest(spark, str(landing), bronze, checkpoint)
    written = list((tmp_path / "bronze").rglob("part-*.parquet"))
    assert len(written) == 10 and read_bronze(spark, bronze).count() == 160


def test_many_batches_are_joined(spark, tmp_path):
    _, bronze, _ = places(tmp_path)
    columns = StructType([StructField(f.name, f.dataType) for f in BRONZE])
    for n in range(50):
        times = [f"2026-05-0{1 + n % 2} {n % 24:02d}:00:00", "bad" if n == 7 else "2026-05-09 00:00:00"]
        rows = [(f"K{n}", "C", t, *[None] * 6, datetime(2026, 6, 1), "f") for t in times]
        write_batch(spark.createDataFrame(rows, columns), n, bronze)
    before = sorted(map(str, read_bronze(spark, bronze).collect()))
    assert len(before) == 100
    compact(spark, bronze, [date(2026, 5, 1)])
    compact(spark, bronze)
    compact(spark, bronze)
    assert sorted(map(str, read_bronze(spark, bronze).collect())) == before
    days = list((tmp_path / "bronze").glob("reading_day=*"))
    assert len(days) == 4
    assert all(len(list(day.rglob("part-*.parquet"))) == 1 for day in days)
    # The log of the batches is as before, and later batches are added.
    assert days_of_batches(spark, bronze, 47) == {date(2026, 5, d) for d in (1, 2, 9)}
    write_batch(spark.createDataFrame(rows, columns), 50, bronze)
    assert read_bronze(spark, bronze).count() == 102


def test_a_compaction_that_stopped_is_finished(spark, tmp_path, monkeypatch):
    _, bronze, _ = places(tmp_path)
    columns = StructType([StructField(f.name, f.dataType) for f in BRONZE])
    for n in range(3):
        rows = [(f"K{n}", "C", f"2026-05-0{d} 10:00:00", *[None] * 6, datetime(2026, 6, 1), "f") for d in (1, 2)]
        write_batch(spark.createDataFrame(rows, columns), n, bronze)
    before = sorted(map(str, read_bronze(spark, bronze).collect()))
    real = module.move

    def stops(spark, source, target):
        if "05-02" in source:
            raise OSError("lost")
        real(spark, source, target)

    monkeypatch.setattr(module, "move", stops)
    with pytest.raises(OSError, match="lost"):
        compact(spark, bronze)
    monkeypatch.setattr(module, "move", real)
    compact(spark, bronze)
    assert sorted(map(str, read_bronze(spark, bronze).collect())) == before
    assert len(list((tmp_path / "bronze").rglob("part-*.parquet"))) == 2
    assert not (tmp_path / "bronze_compacting").exists()


def test_ingested_files_can_be_archived(spark, tmp_path):
    landing, bronze, checkpoint = places(tmp_path)
    archive = tmp_path / "archive"
    archive.mkdir()
    for name in ("a", "b", "c"):
        drop_file(landing, f"{name}.json", reading(name))
        ingest(spark, str(landing), bronze, checkpoint, archive=str(archive))
    out = read_bronze(spark, bronze)
    assert sorted(r.collar_id for r in out.collect()) == ["a", "b", "c"]
    assert {f.name for f in archive.rglob("*.json")} >= {"a.json"}


def test_stream_can_run_on_and_be_stopped(spark, tmp_path):
    landing, bronze, checkpoint = places(tmp_path)
    drop_file(landing, "a.json", reading("K1"))
    stream = with_ingest_audit(read_landing(spark, str(landing)))
    assert stream.isStreaming
    running = start_bronze(stream, bronze, checkpoint, continuous=True)
    try:
        running.processAllAvailable()
        drop_file(landing, "b.json", reading("K2"))
        running.processAllAvailable()
    finally:
        running.stop()
    assert read_bronze(spark, bronze).agg(F.count_distinct("collar_id")).first()[0] == 2


def test_files_with_old_times_are_not_lost(spark, tmp_path):
    """Late uploads and moved files keep their old times."""
    landing, bronze, checkpoint = places(tmp_path)
    for name, days in (("a", 0), ("b", 8), ("c", 400), ("d", 0)):
        drop_file(landing, f"{name}.json", reading(name))
        then = time.time() - days * 86_400
        os.utime(landing / f"{name}.json", (then, then))
        ingest(spark, str(landing), bronze, checkpoint)
    assert sorted(r.collar_id for r in read_bronze(spark, bronze).collect()) == list("abcd")


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    landing, bronze, checkpoint = places(tmp_path)
    drop_file(landing, "a.json", reading("K1"), reading("K2", reading_time="bad"))
    ingest(spark, str(landing), bronze, checkpoint)
    nullable = StructType([StructField(f.name, f.dataType) for f in BRONZE])
    write_batch(spark.createDataFrame(read_bronze(spark, bronze).collect(), nullable), 0, bronze)
    assert read_bronze(spark, bronze).count() == 2


def test_a_day_is_read_without_the_others(spark, tmp_path):
    """Though every file holds a time that cannot be parsed."""
    landing, bronze, checkpoint = places(tmp_path)
    for day in range(1, 6):
        times = [f"2026-05-0{day} 10:00:00"] * 3 + ["zzz"]
        drop_file(landing, f"{day}.json", *(reading("K", reading_time=t) for t in times))
        ingest(spark, str(landing), bronze, checkpoint)
    one = read_bronze(spark, bronze, [date(2026, 5, 2)])
    assert one.count() == 3
    filters = re.search(r"PartitionFilters: \[[^]]*reading_day", plan_of(one))
    assert filters is not None
    read = one.select("source_file").distinct().collect()
    assert len(read) == 1 and read[0].source_file.endswith("2.json")
    assert read_bronze(spark, bronze, [None]).count() == 5
    assert read_bronze(spark, bronze, [None, date(2026, 5, 5)]).count() == 8
    assert read_bronze(spark, bronze, [date(2026, 6, 1)]).count() == 0
    # Other days' folders are not even listed.
    assert re.search(r"\(1 paths\)\[[^]]*reading_day=2026-05-02\]", plan_of(one))


def test_scratch_is_in_the_shared_folder_and_new_each_time(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    if shared is not None:
        assert first.startswith(shared)
