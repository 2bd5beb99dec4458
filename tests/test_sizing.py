"""Numbers of tasks, scratch folders, and the command line."""

from __future__ import annotations

from datetime import date
from pathlib import Path
from types import SimpleNamespace

import pytest

from collarlake import __main__ as command
from collarlake import sizing
from collarlake.plans import lake
from collarlake.sources import tables
from collarlake.workspace import scratch_dir
from tests.conftest import plan_of
from tests.test_lake import place, reading  # noqa: F401
from tests.test_streaming import drop_file

TB = 1024**4


def test_task_numbers_grow_with_the_data_up_to_their_bounds():
    assert sizing.shuffle_partitions(TB) == 12_288
    assert sizing.shuffle_partitions(100 * TB) == sizing.MAX_SHUFFLE_PARTITIONS
    assert sizing.scan_bytes(100 * TB) == pytest.approx(1.05 * 1024**3, rel=0.05)


def test_settings_are_raised_within_the_block_only(spark, monkeypatch):
    df = spark.range(1)
    before = spark.conf.get(sizing.SHUFFLE_PARTITIONS), spark.conf.get(sizing.SCAN_BYTES)
    with sizing.sized_for(df):
        assert spark.conf.get(sizing.SHUFFLE_PARTITIONS) == before[0]
    monkeypatch.setattr(sizing, "estimated_bytes", lambda df: 100 * TB)
    with pytest.raises(KeyError), sizing.sized_for(df):
        assert spark.conf.get(sizing.SHUFFLE_PARTITIONS) == "50000"
        assert int(spark.conf.get(sizing.SCAN_BYTES)) > 1024**3
        raise KeyError
    assert before == (spark.conf.get(sizing.SHUFFLE_PARTITIONS), spark.conf.get(sizing.SCAN_BYTES))


def fake(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: folder),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_needs_a_shared_folder_on_a_cluster():
    assert scratch_dir(fake("s3://shared/", "yarn"), "x").startswith("s3://shared/x-")
    assert "collarlake-" in scratch_dir(fake(None, "local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(fake(None, "yarn"), "x")


def test_no_broadcast_is_forced():
    """Only Catalyst, which checks sizes, may broadcast; and nothing is collected into a task."""
    for file in Path(command.__file__).parent.rglob("*.py"):
        text = file.read_text()
        for word in ("broadcast(", "localCheckpoint", "collect_list", "toPandas", "crossJoin"):
            assert word not in text, (file, word)


def test_command_runs_the_steps_in_order(spark, place, tmp_path, monkeypatch):  # noqa: F811
    monkeypatch.setattr(command, "build_session", lambda: spark)
    where = ["--root", place.root, "--landing", place.landing, "--registry", place.registry]
    command.main([*where, "--steps", "staging", "silver", "bronze"])
    command.main([*where, "--steps", "marts", "check", "--as-of", "2026-06-01"])
    mart = tables.read(spark, place.path("bi_flat"))
    assert mart.count() == 4
    command.main([*where, "--days", "2026-05-01", "--as-of", "2026-06-01"])
    assert tables.read(spark, place.path("bi_flat")).count() == 4
    # What is new is found without naming days; a full build comes first.
    command.main([*where, "--new", "--as-of", "2026-06-01"])
    assert lake.days_to_build(spark, place, date(2026, 6, 1)) == set()
    drop_file(tmp_path / "landing", "new.json", reading("C1", 7, 0))
    command.main([*where, "--new", "--compact", "--as-of", "2026-06-01"])
    assert tables.read(spark, place.path("bi_flat")).count() == 5
    assert command.parse([*where, "--stop-at-bad-files"]).stop_at_bad_files
    days = command.parse([*where, "--days", "2026-05-01", "undated"]).days
    assert days == [date(2026, 5, 1), None]


def test_audit_reads_no_columns(spark, tmp_path):
    tables.overwrite(spark.range(5), str(tmp_path / "t"))
    assert "ReadSchema: struct<>" in plan_of(tables.load_audit(spark, {"t": str(tmp_path / "t")}))
