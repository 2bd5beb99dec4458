"""Joins, aggregates, the window, sorts and the dashboard queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from collarlake.operators import dashboard, daily
from collarlake.operators.joins import join_profiles
from collarlake.plans.silver import READING_KEY
from parity import adapter
from parity.catalog import query

# Dashboard selections used below. Days and names are those of the given tables.
FIRST, LAST = date(2024, 1, 8), date(2024, 1, 21)
CAT_NAME, CAT_ID = "Customer#000000003", "C3"
IN_RANGE = f"reading_date between date '{FIRST}' and date '{LAST}'"


@query("dedup_latest", "select * from dedup")
def dedup_latest(spark, sf_dir):
    return adapter.deduplicated(spark, sf_dir)


SILVER = """select * replace (cast(birth_date as string) as birth_date,
                              cast(weight_lbs as string) as weight_lbs,
                              cast(registered_at as string) as registered_at) from silver"""


@query("join_registry_inner", SILVER)
def join_registry_inner(spark, sf_dir):
    return adapter.silver_table(spark, sf_dir)


@query("join_registry_salted", "select * from silver")
def join_registry_salted(spark, sf_dir):
    """The same join the way it runs when the registry is too large to broadcast."""
    return join_profiles(
        adapter.deduplicated(spark, sf_dir),
        adapter.registry_typed(spark, sf_dir),
        spread_by=READING_KEY,
        broadcast_limit=0,
    )


@query("join_health_profile_left", "select * from unmatched_bi")
def join_health_profile_left(spark, sf_dir):
    return adapter.unmatched_bi(spark, sf_dir)


@query("bi", "select * from bi")
def bi(spark, sf_dir):
    return adapter.bi(spark, sf_dir)


@query("daily_group", "select * from daily")
def daily_group(spark, sf_dir):
    return adapter.daily(spark, sf_dir)


def _measures(spark, sf_dir, *names):
    return daily.daily_measures(adapter.staged(spark, sf_dir)).select(
        "cat_id", "reading_date", *names
    )


@query(
    "agg_avg_if", "select cat_id, reading_date, round(heart, 6) as avg_heart_rate_bpm from measures"
)
def agg_avg_if(spark, sf_dir):
    value = F.round("avg_heart_rate_bpm", 6).alias("avg_heart_rate_bpm")
    return _measures(spark, sf_dir, value)


@query("agg_sum", "select cat_id, reading_date, total_daily_steps from measures")
def agg_sum(spark, sf_dir):
    return _measures(spark, sf_dir, "total_daily_steps")


@query(
    "agg_avg",
    """select cat_id, reading_date, round(purr, 6) as avg_purr_frequency_hz,
              round(temp, 6) as avg_ambient_temp_c from measures""",
)
def agg_avg(spark, sf_dir):
    names = ("avg_purr_frequency_hz", "avg_ambient_temp_c")
    return _measures(spark, sf_dir, *(F.round(n, 6).alias(n) for n in names))


@query("agg_min", "select cat_id, reading_date, min_battery_level_pct from measures")
def agg_min(spark, sf_dir):
    return _measures(spark, sf_dir, "min_battery_level_pct")


@query(
    "agg_count_if",
    """select cat_id, reading_date, estimated_sleep_minutes, estimated_active_minutes,
              estimated_lazy_minutes from measures""",
)
def agg_count_if(spark, sf_dir):
    return _measures(
        spark, sf_dir, "estimated_sleep_minutes", "estimated_active_minutes",
        "estimated_lazy_minutes",
    )


@query("agg_count_all", "select cat_id, reading_date, total_readings_logged from measures")
def agg_count_all(spark, sf_dir):
    return _measures(spark, sf_dir, "total_readings_logged")


KPIS = """select cast(trunc(avg(total_daily_steps)) as bigint) as avg_steps,
    cast(trunc(avg(estimated_sleep_minutes)) as bigint) as avg_sleep_minutes,
    round_even(avg(avg_purr_frequency_hz), 1) as avg_purr_hz,
    cast(trunc(avg(daily_feline_health_score)) as bigint) as avg_health_score from shown"""


@query("dash_kpis", KPIS)
def dash_kpis(spark, sf_dir):
    return dashboard.kpis(dashboard.select_days(adapter.bi(spark, sf_dir)))


@query(
    "dash_kpi_deltas",
    f"""select avg_steps - 3000 as steps_delta, avg_sleep_minutes // 60 as sleep_hours,
               avg_sleep_minutes % 60 as sleep_minutes, avg_sleep_minutes - 840 as sleep_delta,
               avg_health_score - 75 as score_delta from ({KPIS})""",
)
def dash_kpi_deltas(spark, sf_dir):
    return dashboard.kpi_deltas(dashboard.select_days(adapter.bi(spark, sf_dir)))


@query("dash_date_bounds", "select min(reading_date) as min_date, max(reading_date) as max_date from bi")
def dash_date_bounds(spark, sf_dir):
    return dashboard.date_bounds(adapter.bi(spark, sf_dir))


@query(
    "dash_activity_mix",
    """select activity, avg_minutes, avg_minutes / (s + a + l) as share
       from (select avg(estimated_sleep_minutes) as s, avg(estimated_active_minutes) as a,
                    avg(estimated_lazy_minutes) as l from shown)
       cross join lateral (values ('Sleep', s), ('Active Play', a), ('Lazy Lounging', l))
             as t(activity, avg_minutes)""",
)
def dash_activity_mix(spark, sf_dir):
    return dashboard.activity_mix(dashboard.select_days(adapter.bi(spark, sf_dir)))


@query("distinct_cats", "select distinct cat_name from unmatched_bi where cat_name is not null")
def distinct_cats(spark, sf_dir):
    mart = adapter.unmatched_bi(spark, sf_dir)
    return mart.select("cat_name").dropna().distinct()


@query(
    "sort_names",
    "select distinct cat_name from unmatched_bi where cat_name is not null order by cat_name",
)
def sort_names(spark, sf_dir):
    return dashboard.cat_names(adapter.unmatched_bi(spark, sf_dir))


@query(
    "dedup_cats",
    """select distinct cat_id, cat_name, breed, gender, age_years, human_equivalent_age,
              weight_lbs, weight_category from unmatched_shown where cat_id is not null""",
)
def dedup_cats(spark, sf_dir):
    return dashboard.cat_profiles(dashboard.select_days(adapter.unmatched_bi(spark, sf_dir)))


@query(
    "first_row_profile",
    f"""select distinct cat_id, cat_name, breed, gender, age_years, human_equivalent_age,
               weight_lbs, weight_category from shown where cat_name = '{CAT_NAME}'""",
)
def first_row_profile(spark, sf_dir):
    mart = adapter.bi(spark, sf_dir)
    return dashboard.cat_profiles(dashboard.select_days(mart, name=CAT_NAME))


@query("dash_filter_dates", f"select * from bi where {IN_RANGE}")
def dash_filter_dates(spark, sf_dir):
    return dashboard.select_days(adapter.bi(spark, sf_dir), FIRST, LAST)


@query("dash_filter_cat", f"select * from bi where cat_name = '{CAT_NAME}'")
def dash_filter_cat(spark, sf_dir):
    return dashboard.filter_cat(adapter.bi(spark, sf_dir), CAT_NAME)


@query("dash_filter_cat_id", f"select * from bi where {IN_RANGE} and cat_id = '{CAT_ID}'")
def dash_filter_cat_id(spark, sf_dir):
    return dashboard.select_days(adapter.bi(spark, sf_dir), FIRST, LAST, cat_id=CAT_ID)


@query("dash_empty_check", f"select count(*) > 0 as has_rows from bi where {IN_RANGE}")
def dash_empty_check(spark, sf_dir):
    return dashboard.has_rows(dashboard.select_days(adapter.bi(spark, sf_dir), FIRST, LAST))


@query(
    "latest_per_cat",
    """select cat_id, reading_date, daily_feline_health_score, health_status_category from shown
       where cat_id is not null
       qualify row_number() over (partition by cat_id order by reading_date desc) = 1""",
)
def latest_per_cat(spark, sf_dir):
    return dashboard.latest_per_cat(dashboard.select_days(adapter.bi(spark, sf_dir)))


@query(
    "latest_one_cat",
    f"""select cat_name, reading_date, daily_feline_health_score, health_status_category,
               avg_heart_rate_bpm,
               case when avg_heart_rate_bpm < 100 then 'low'
                    when avg_heart_rate_bpm <= 180 then 'normal'
                    when avg_heart_rate_bpm > 180 then 'high' end as heart_rate_zone
        from shown where cat_name = '{CAT_NAME}'
        order by reading_date desc nulls last, daily_summary_id desc limit 1""",
)
def latest_one_cat(spark, sf_dir):
    return dashboard.latest_day(dashboard.select_days(adapter.bi(spark, sf_dir), name=CAT_NAME))


@query(
    "detail_table",
    """select cat_name, breed, reading_date, avg_heart_rate_bpm, total_daily_steps,
              avg_purr_frequency_hz, estimated_sleep_minutes, daily_feline_health_score,
              health_status_category from shown
       order by reading_date desc, cat_name, daily_summary_id""",
)
def detail_table(spark, sf_dir):
    return dashboard.detail_table(dashboard.select_days(adapter.bi(spark, sf_dir)))


@query(
    "step_trend",
    """select reading_date, cat_name, total_daily_steps from shown
       order by reading_date, cat_name, daily_summary_id""",
)
def step_trend(spark, sf_dir):
    return dashboard.step_trend(dashboard.select_days(adapter.bi(spark, sf_dir)))


@query(
    "bi_activity_by_hour",
    """select cast(hour(reading_time) as int) as hour_of_day,
              count(*) filter (activity_level = 'active') as active_readings,
              count(*) as readings from fact group by all""",
)
def bi_activity_by_hour(spark, sf_dir):
    return dashboard.activity_by_hour(adapter.fact(spark, sf_dir))


@query(
    "bi_sleep_by_breed",
    "select breed, avg(estimated_sleep_minutes) as avg_sleep_minutes from bi group by breed",
)
def bi_sleep_by_breed(spark, sf_dir):
    return dashboard.sleep_by_breed(adapter.bi(spark, sf_dir))


@query(
    "bi_heart_anomalies",
    """select reading_id, cat_id, reading_time, heart_rate_bpm, cardiac_status from fact
       where cardiac_status <> 'normal'""",
)
def bi_heart_anomalies(spark, sf_dir):
    return dashboard.heart_rate_anomalies(adapter.fact(spark, sf_dir))


SINCE = date(2024, 1, 16)


@query(
    "bi_heart_excursions",
    f"""select reading_id, f.cat_id, reading_time, heart_rate_bpm, median, n_readings
        from fact f join (
            select cat_id, count(*) as n_readings,
                   quantile_disc(heart_rate_bpm, 0.25) as low,
                   cast(quantile_disc(heart_rate_bpm, 0.5) as bigint) as median,
                   quantile_disc(heart_rate_bpm, 0.75) as high
            from fact
            where heart_rate_bpm > 0 and cast(reading_time as date) < date '{SINCE}'
            group by cat_id having count(*) >= 8) b on b.cat_id = f.cat_id
        where heart_rate_bpm > 0 and cast(reading_time as date) >= date '{SINCE}'
          and (heart_rate_bpm < low - 1.5 * (high - low)
               or heart_rate_bpm > high + 1.5 * (high - low))""",
)
def bi_heart_excursions(spark, sf_dir):
    """Heart rates against each animal's own earlier ones."""
    return dashboard.heart_rate_excursions(adapter.fact(spark, sf_dir), SINCE)
