"""Dashboard queries on the flat mart. They filter and aggregate before anything is fetched."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collarlake import constants as k
from collarlake.functions.cleaning import initial_capital
from collarlake.functions.health import heart_rate_zone
from collarlake.functions.numbers import round_half_even, truncate_to_int

PROFILE = (
    "cat_id", "cat_name", "breed", "gender", "age_years", "human_equivalent_age",
    "weight_lbs", "weight_category",
)

DETAIL = (
    "cat_name", "breed", "reading_date", "avg_heart_rate_bpm", "total_daily_steps",
    "avg_purr_frequency_hz", "estimated_sleep_minutes", "daily_feline_health_score",
    "health_status_category",
)


def cat_names(mart: DataFrame) -> DataFrame:
    """Distinct names in order. Days without a profile have no name and are left out."""
    return mart.select("cat_name").dropna().distinct().orderBy("cat_name")


def date_bounds(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.min("reading_date").alias("min_date"), F.max("reading_date").alias("max_date")
    )


def filter_cat(mart: DataFrame, name: str = k.ALL_CATS, cat_id: str | None = None) -> DataFrame:
    """Days of the named cat, or of all. Names may repeat; ``cat_id`` picks exactly one."""
    if name != k.ALL_CATS:
        mart = mart.filter(F.col("cat_name") == name)
    if cat_id is not None:
        mart = mart.filter(F.col("cat_id") == cat_id)
    return mart


# More ids than this are no filter that a scan can use to skip files.
MOST_IDS = 1000


def filter_named(mart: DataFrame, cats: DataFrame, name: str) -> DataFrame:
    """Days of all cats of a name, found by their ids: the dimension is small beside the mart,
    whose files are ordered by id and can be skipped by it. A name that very many cats have
    is filtered as a name."""
    ids = [row[0] for row in cats.filter(F.col("cat_name") == name).select("cat_id").take(MOST_IDS + 1)]
    if len(ids) > MOST_IDS:
        return filter_cat(mart, name)
    return mart.filter(F.col("cat_id").isin(ids) & (F.col("cat_name") == name))


def select_days(
    mart: DataFrame,
    first: date | None = None,
    last: date | None = None,
    name: str = k.ALL_CATS,
    cat_id: str | None = None,
) -> DataFrame:
    """The dashboard's selection: a range of days, by default all, and one cat or all.

    Days are picked on a scale of dates, so rows without a date are never selected.
    """
    dated = mart.dropna(subset=["reading_date"])
    if first is not None:
        dated = dated.filter(F.col("reading_date") >= F.lit(first))
    if last is not None:
        dated = dated.filter(F.col("reading_date") <= F.lit(last))
    return filter_cat(dated, name, cat_id)


def has_rows(mart: DataFrame) -> DataFrame:
    """One row, one flag. Each task reads up to its first row, and only a flag is shuffled."""
    return mart.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows"))


def kpis(mart: DataFrame) -> DataFrame:
    """Means over all days: steps, sleep and score truncated, purr to one decimal."""
    return mart.agg(
        truncate_to_int(F.avg("total_daily_steps")).alias("avg_steps"),
        truncate_to_int(F.avg("estimated_sleep_minutes")).alias("avg_sleep_minutes"),
        round_half_even(F.avg("avg_purr_frequency_hz"), 1).alias("avg_purr_hz"),
        truncate_to_int(F.avg("daily_feline_health_score")).alias("avg_health_score"),
    )


def kpi_deltas(mart: DataFrame) -> DataFrame:
    """The means against their baselines, and sleep as hours and minutes."""
    sleep = F.col("avg_sleep_minutes")
    return kpis(mart).select(
        (F.col("avg_steps") - k.BASELINE_STEPS).alias("steps_delta"),
        F.floor(sleep / 60).alias("sleep_hours"),
        (sleep % 60).alias("sleep_minutes"),
        (sleep - k.BASELINE_SLEEP_MINUTES).alias("sleep_delta"),
        (F.col("avg_health_score") - k.TARGET_SCORE).alias("score_delta"),
    )


def activity_mix(mart: DataFrame) -> DataFrame:
    """Mean minutes per activity, one row each, and the share of their sum."""
    means = mart.agg(
        F.avg("estimated_sleep_minutes").alias("Sleep"),
        F.avg("estimated_active_minutes").alias("Active Play"),
        F.avg("estimated_lazy_minutes").alias("Lazy Lounging"),
    )
    names = means.columns
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return (
        means.withColumn("_total", total)
        .unpivot(["_total"], names, "activity", "avg_minutes")
        .select("activity", "avg_minutes", F.try_divide("avg_minutes", "_total").alias("share"))
    )


def step_trend(mart: DataFrame) -> DataFrame:
    """Steps per day and cat, in date order. The row key as last sort column lets a
    day with very many rows be split over several sort tasks."""
    return mart.orderBy("reading_date", "cat_name", "daily_summary_id").select(
        "reading_date", "cat_name", "total_daily_steps"
    )


def detail_table(mart: DataFrame) -> DataFrame:
    """The detail columns, newest day first."""
    return mart.orderBy(F.desc("reading_date"), "cat_name", "daily_summary_id").select(*DETAIL)


def cat_profiles(mart: DataFrame) -> DataFrame:
    """One row of profile columns per cat: those of its last day, since days that were built
    at different times may hold different ages and weights."""
    last = F.max_by(F.struct(*PROFILE), F.struct("reading_date", "daily_summary_id"))
    return mart.dropna(subset=["cat_id"]).groupBy("cat_id").agg(last.alias("p")).select("p.*")


def display_profiles(mart: DataFrame) -> DataFrame:
    """Profiles with the gender as it is shown."""
    return cat_profiles(mart).withColumn("gender", initial_capital(F.col("gender")))


def latest_per_cat(mart: DataFrame) -> DataFrame:
    """Score and category of each cat's last day, for all cats in one aggregate."""
    last_day = F.struct("reading_date", "daily_feline_health_score", "health_status_category")
    return (
        mart.dropna(subset=["cat_id", "reading_date"])
        .groupBy("cat_id")
        .agg(F.max(last_day).alias("_last"))
        .select("cat_id", "_last.*")
    )


def latest_day(mart: DataFrame) -> DataFrame:
    """The newest day of the given rows: score, category, heart rate and its gauge zone."""
    return (
        mart.orderBy(F.desc_nulls_last("reading_date"), F.desc("daily_summary_id"))
        .limit(1)
        .select(
            "cat_name",
            "reading_date",
            "daily_feline_health_score",
            "health_status_category",
            "avg_heart_rate_bpm",
            heart_rate_zone(F.col("avg_heart_rate_bpm")).alias("heart_rate_zone"),
        )
    )


def sleep_by_breed(mart: DataFrame) -> DataFrame:
    """Mean daily sleep per breed."""
    return mart.groupBy("breed").agg(F.avg("estimated_sleep_minutes").alias("avg_sleep_minutes"))


def activity_by_hour(fact: DataFrame) -> DataFrame:
    """Active readings and all readings per hour of the day."""
    return fact.groupBy(F.hour("reading_time").alias("hour_of_day")).agg(
        F.count_if(F.col("activity_level") == k.ACTIVE).alias("active_readings"),
        F.count(F.lit(1)).alias("readings"),
    )


def heart_rate_anomalies(fact: DataFrame) -> DataFrame:
    """Readings whose cardiac status is not normal."""
    return fact.filter(F.col("cardiac_status") != "normal").select(
        "reading_id", "cat_id", "reading_time", "heart_rate_bpm", "cardiac_status"
    )


# An excursion is further from the middle half of the baseline than this many times its width.
FENCE = 1.5
# Fewer readings are no baseline.
LEAST_READINGS = 8
# Readings of an animal up to this number are kept exactly; a sketch of more is as good as
# this many allow, and of a bounded size.
SKETCH = 1024


def heart_baselines(fact: DataFrame, until: date) -> DataFrame:
    """Each animal's heart rate before a day: readings, quartiles. Sketches are merged per
    task before the shuffle, so an animal with very many readings sends a few."""
    rate = F.col("heart_rate_bpm")
    before = fact.filter((rate > 0) & (F.to_date("reading_time") < F.lit(until)))
    sketch = F.kll_sketch_agg_bigint(rate.cast("long"), F.lit(SKETCH))
    one = before.groupBy("cat_id").agg(F.count(F.lit(1)).alias("n_readings"), sketch.alias("_s"))

    def quantile(rank: float):
        return F.kll_sketch_get_quantile_bigint("_s", F.lit(rank))

    return one.filter((F.col("n_readings") >= LEAST_READINGS) & F.col("cat_id").isNotNull()).select(
        "cat_id",
        "n_readings",
        quantile(0.25).alias("low_quartile"),
        quantile(0.5).alias("median"),
        quantile(0.75).alias("high_quartile"),
    )


def heart_rate_excursions(fact: DataFrame, since: date) -> DataFrame:
    """Readings from a day on that are far from the animal's own baseline, that of the days
    before. Animals without a baseline have none."""
    rate = F.col("heart_rate_bpm")
    later = fact.filter((rate > 0) & (F.to_date("reading_time") >= F.lit(since)))
    width = (F.col("high_quartile") - F.col("low_quartile")) * F.lit(FENCE)
    far = (rate < F.col("low_quartile") - width) | (rate > F.col("high_quartile") + width)
    return later.join(heart_baselines(fact, since), "cat_id").filter(far).select(
        "reading_id", "cat_id", "reading_time", "heart_rate_bpm", "median", "n_readings"
    )
