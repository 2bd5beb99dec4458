"""Rounding that gives one answer however Spark split the data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A double average differs in its last bits with the order of its partial sums. This many
# decimals drop that noise before the value is rounded half up.
FLOAT_AVERAGE_SCALE = 10
# The warehouse gives an average of integers six decimals.
INTEGER_AVERAGE_SCALE = 6


def round_half_up(value: Column, places: int, scale: int = FLOAT_AVERAGE_SCALE) -> Column:
    """Round a double half up. Values too large for the decimal have no fraction: kept as is."""
    exact = value.try_cast(f"decimal(28,{scale})")
    return F.coalesce(F.round(exact, places).cast("double"), value)


def round_half_even(value: Column, places: int) -> Column:
    """Round a double to the nearest, ties to the even digit, as Python frames do."""
    scale = F.lit(float(10**places))
    return F.rint(value * scale) / scale


def truncate_to_int(value: Column) -> Column:
    """Drop the fraction."""
    return value.cast("bigint")
