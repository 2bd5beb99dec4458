"""Attributes of an animal."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from collarlake import constants as k


def as_of_date(as_of: date | None) -> Column:
    """The day ages refer to; today unless given."""
    return F.current_date() if as_of is None else F.lit(as_of)


def age_years(birth_date: Column, as_of: Column) -> Column:
    """Calendar years between the two dates: the number of New Year's days passed."""
    return F.year(as_of) - F.year(birth_date)


def human_equivalent_age(age: Column) -> Column:
    """Fixed values for the first years, then a constant number per year. NULL age gives NULL."""
    last, at_last = max(k.HUMAN_AGE_FIRST_YEARS.items())
    later = F.lit(at_last) + (age - last) * k.HUMAN_YEARS_PER_LATER_YEAR
    result = None
    for years, human in k.HUMAN_AGE_FIRST_YEARS.items():
        result = (F if result is None else result).when(age == years, human)
    return result.otherwise(later)


def weight_category(pounds: Column) -> Column:
    """Weight class. A missing weight fits no limit and gets the last class."""
    return (
        F.when(pounds < k.UNDERWEIGHT_BELOW, "underweight")
        .when(pounds <= k.HEALTHY_UP_TO, "healthy weight")
        .when(pounds <= k.OVERWEIGHT_UP_TO, "overweight")
        .otherwise("obese")
    )
