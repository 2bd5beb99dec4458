"""Joining readings with a table that has a row per animal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collarlake.sizing import estimated_bytes

# Most tasks that the readings of one animal are spread over where they have to be shuffled,
# and so how often each profile is repeated. A third of 10^12 readings of one animal gives
# tasks that adaptive execution can split further.
SALTS = 32
# Fewest tasks, however many animals there are beside the readings.
FEWEST_SALTS = 4
# Between the two, repeated profiles come to about this part of the readings' bytes.
REPEATED_PART = 4


def broadcast_threshold(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def limited(profiles: DataFrame, broadcast_limit: int | None = None) -> DataFrame:
    """Profiles that Catalyst may broadcast only if they are below the limit with all their
    columns, by default the session's threshold.

    Catalyst itself compares the columns that a query reads, in bytes as they are in a file.
    Of ids alone this lets many times the threshold through to the driver.
    """
    limit = broadcast_threshold(profiles) if broadcast_limit is None else broadcast_limit
    return profiles if estimated_bytes(profiles) <= limit else profiles.hint("merge")


def salts_for(reading_bytes: int, profile_bytes: int) -> int:
    """As many salts as keep the repeated profiles small beside the readings, within bounds."""
    fitting = reading_bytes // (REPEATED_PART * max(profile_bytes, 1))
    return min(max(fitting, FEWEST_SALTS), SALTS)


def salted(
    readings: DataFrame, profiles: DataFrame, spread_by: Sequence[str], salts: int = SALTS
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``_salt``: one of ``salts`` per reading, all per profile.

    A reading's salt is a hash of its own columns, so a task that runs again after a
    lost executor gives the same salts.
    """
    left = readings.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    return left, profiles.withColumn("_salt", F.explode(every))


def join_profiles(
    readings: DataFrame,
    profiles: DataFrame,
    *,
    key: str = "cat_id",
    spread_by: Sequence[str],
    salts: int | None = None,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Inner join on ``key``, one key column out, safe against hot keys. Lazy: no job runs.

    While ``profiles`` is below ``broadcast_limit`` bytes, by default the session's
    broadcast threshold, this is a plain join and Catalyst broadcasts it: readings are
    not shuffled. Above it the readings must be shuffled by key, and one animal may
    hold a large part of them. So the readings of every animal are spread over ``salts``
    by a hash of ``spread_by``, in the only shuffle that they go through, and profiles
    are repeated once per salt. By default the salts are as many as ``salts_for`` says.

    The repeated profiles are never broadcast. Catalyst's estimate does not count the
    repeats, so where a query reads few columns it would take them for a small table.
    """
    limit = broadcast_threshold(profiles) if broadcast_limit is None else broadcast_limit
    size = estimated_bytes(profiles)
    if size <= limit:
        return readings.join(profiles, key, "inner")
    if salts is None:
        salts = salts_for(estimated_bytes(readings), size)
    left, right = salted(readings, profiles, spread_by, salts)
    return left.join(right.hint("merge"), [key, "_salt"], "inner").drop("_salt")
