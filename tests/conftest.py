from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from collarlake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "collarlake-tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            # Tests look for filters in plan texts; do not cut them.
            "spark.sql.maxMetadataStringLength": "2000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def column(df) -> list:
    return [row[0] for row in df.collect()]
