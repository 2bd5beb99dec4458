"""Data checks. Each returns the rows that fail; an empty result means the check passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collarlake import constants as k


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def duplicate_values(df: DataFrame, *columns: str) -> DataFrame:
    """Values found more than once, with their number of rows. NULL is not a value."""
    counts = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def orphan_values(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Values of ``child`` missing in ``parent``, with their number of child rows.

    Child rows are counted per value first, so the join sees one row per value however
    many rows the most frequent value has.
    """
    values = child.dropna(subset=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return values.join(parent.select(column), column, "left_anti")


def _impossible_heart_rate() -> Column:
    bpm = F.col("heart_rate_bpm")
    return (bpm > k.HEART_RATE_MAX) | ((bpm < 0) & (bpm != k.MISSING_SENSOR))


def impossible_heart_rates(readings: DataFrame) -> DataFrame:
    """Rates above the physical limit, or negative without being the missing marker."""
    return readings.filter(_impossible_heart_rate()).select("reading_id", "cat_id", "heart_rate_bpm")


def days_longer_than_a_day(daily: DataFrame) -> DataFrame:
    """Days with more estimated sleep than a day has minutes."""
    return daily.filter(F.col("estimated_sleep_minutes") > k.MINUTES_PER_DAY).select(
        "daily_summary_id", "cat_id", "reading_date", "estimated_sleep_minutes"
    )


def unparsed_times(silver: DataFrame) -> DataFrame:
    """Rows per collar whose reading time could not be parsed (one is left after deduplication)."""
    return null_rows(silver, "parsed_reading_time").groupBy("collar_id").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def _group_count(df: DataFrame, table: str, check: str) -> DataFrame:
    """Failing values, for a check that returns a row per value."""
    return df.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table"), F.lit(check).alias("check"), "failures"
    )


# Sums of this many lower bits of fingerprints cannot overflow.
LOW_BITS = (1 << 24) - 1


class Content(NamedTuple):
    """What the values of a column are, whatever their order: rows, and two sums of their
    8-byte fingerprints."""

    rows: int
    xor: int
    low: int


def _null_count(df: DataFrame, columns: Sequence[str]) -> list[int]:
    row = df.agg(*(F.count_if(F.col(c).isNull()) for c in columns)).first()
    return list(row)


def _print(column: str) -> Column:
    return F.when(F.col(column).isNotNull(), F.xxhash64(column))


def unique_check(
    df: DataFrame, column: str, failing: Column | None = None
) -> tuple[int, int, int, Content]:
    """In one pass over the table: rows without a value, values found more than once, rows that
    fail another check, and the column's content.

    The shuffle carries 8-byte fingerprints with counts. Only if some fingerprint is found
    more than once are its rows' values looked at, since two values may share one.
    """
    failing = F.lit(False) if failing is None else failing
    prints = df.groupBy(_print(column).alias("print")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(failing).alias("failing")
    )
    value, n = F.col("print"), F.col("n_rows")
    one = prints.agg(
        F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)),
        F.count_if(value.isNotNull() & (n > 1)),
        F.coalesce(F.sum("failing"), F.lit(0)),
        F.coalesce(F.sum(F.when(value.isNotNull(), n)), F.lit(0)),
        F.coalesce(F.bit_xor(F.when(n % 2 == 1, value)), F.lit(0)),
        F.coalesce(F.sum(n * value.bitwiseAND(LOW_BITS)), F.lit(0)),
    ).first()
    nulls, repeated, failures, *content = one
    if repeated:
        again = prints.filter(n > 1).select(value.alias("again"))
        rows = df.join(again, _print(column) == F.col("again"), "left_semi")
        repeated = duplicate_values(rows, column).count()
    return nulls, repeated, failures, Content(*content)


def fact_check(
    fact: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> tuple[int, int, int, Content]:
    """In one pass over the fact, which is reduced to a row per parent before it is shuffled:
    rows without a value of ``column``, rows without a parent's, values of ``parent_column``
    missing in the parent table, and the content of ``column``."""
    value = _print(column)
    by_parent = fact.groupBy(parent_column).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(column).isNull()).alias("nulls"),
        F.bit_xor(value).alias("xor"),
        F.sum(value.bitwiseAND(LOW_BITS)).alias("low"),
    )
    known = parent.select(F.col(parent_column).alias("known")).distinct()
    joined = by_parent.join(known, F.col(parent_column) == F.col("known"), "left")
    given = F.col(parent_column).isNotNull()
    one = joined.agg(
        F.coalesce(F.sum("nulls"), F.lit(0)),
        F.coalesce(F.sum(F.when(~given, F.col("n_rows"))), F.lit(0)),
        F.count_if(given & F.col("known").isNull()),
        F.coalesce(F.sum(F.col("n_rows") - F.col("nulls")), F.lit(0)),
        F.coalesce(F.bit_xor("xor"), F.lit(0)),
        F.coalesce(F.sum("low"), F.lit(0)),
    ).first()
    nulls, parentless, orphans, *content = one
    return nulls, parentless, orphans, Content(*content)


REPORT = "table string, check string, failures long"


def check_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of failures of every check: columns table, check, failures.

    ``tables`` holds staging_telemetry, staging_registry, stg_telemetry, dim_cats,
    fact_readings and daily_health. Each is read once, unless an id is found more than once. The
    ids of the readings are shuffled once, as fingerprints: where the fact's ids have the
    content of the staged ones, as many of them are repeated.
    """
    t = tables
    spark = t["stg_telemetry"].sparkSession
    jobs = {
        "staging_telemetry": lambda: _null_count(t["staging_telemetry"], ("collar_id", "cat_id")),
        "staging_registry": lambda: unique_check(t["staging_registry"], "cat_id"),
        "stg_telemetry": lambda: unique_check(
            t["stg_telemetry"], "reading_id", _impossible_heart_rate()
        ),
        "dim_cats": lambda: unique_check(t["dim_cats"], "cat_id"),
        "fact_readings": lambda: fact_check(
            t["fact_readings"], "reading_id", t["dim_cats"], "cat_id"
        ),
        "daily_health": lambda: unique_check(t["daily_health"], "daily_summary_id"),
    }
    # The passes do not depend on each other.
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()
        }
        done = {name: job.result() for name, job in running.items()}

    collar, cat = done["staging_telemetry"]
    nulls, repeated, impossible, staged = done["stg_telemetry"]
    fact_nulls, no_cat, orphans, content = done["fact_readings"]
    fact_repeated = repeated
    if content != staged:
        fact_repeated = unique_check(t["fact_readings"], "reading_id")[1]
    found = [
        ("staging_telemetry", "not_null collar_id", collar),
        ("staging_telemetry", "not_null cat_id", cat),
        ("stg_telemetry", "not_null reading_id", nulls),
        ("stg_telemetry", "heart rate possible", impossible),
        ("stg_telemetry", "unique reading_id", repeated),
        ("fact_readings", "not_null reading_id", fact_nulls),
        ("fact_readings", "not_null cat_id", no_cat),
        ("fact_readings", "unique reading_id", fact_repeated),
        ("fact_readings", "cat_id in dim_cats", orphans),
    ]
    for table, column in (
        ("staging_registry", "cat_id"),
        ("dim_cats", "cat_id"),
        ("daily_health", "daily_summary_id"),
    ):
        nulls, repeated, *_ = done[table]
        found += [(table, f"not_null {column}", nulls), (table, f"unique {column}", repeated)]
    return spark.createDataFrame(found, REPORT)


# What a report counts but no run stops for.
WARNING = "warning: "


def warning_report(cleaned: DataFrame, daily: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Like ``check_report``: cleaned raw readings without a valid time, days with more than
    24 hours of sleep, and lines that bronze could not take in whole."""
    parts = [
        _group_count(df, table, WARNING + check)
        for df, table, check in (
            (unparsed_times(cleaned), "bronze", "reading_time parsed"),
            (days_longer_than_a_day(daily), "daily_health", "sleep of a day at most"),
            (quarantine, "bronze", "lines read whole"),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


class ChecksFailed(Exception):
    """Raised when a check found failing rows."""


def require_passed(report: DataFrame) -> None:
    """Raise if any check of a report has failures, but for warnings. It has a row per check."""
    failed = report.filter(~F.col("check").startswith(WARNING) & (F.col("failures") > 0)).collect()
    if failed:
        raise ChecksFailed("; ".join(f"{r.table}: {r.check}: {r.failures}" for r in failed))
