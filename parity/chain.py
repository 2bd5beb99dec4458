"""The model chain as SQL for the comparison engine: one named subquery per table.

Oracles are ``with <CHAIN> select ...``; subqueries that a query does not use cost nothing.
"""

from __future__ import annotations

from parity.adapter import AS_OF, RAW_COLUMNS, REGISTRY_COLUMNS

# Fixed value: the key's token for NULL.
TOKEN = "'_dbt_utils_surrogate_key_null_'"


def key(*texts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce({text}, {TOKEN})" for text in texts) + ")"


def time_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%g')"


def rounded(value: str, places: int, scale: int = 10) -> str:
    return f"cast(round(cast({value} as decimal(28,{scale})), {places}) as double)"


def parsed(column: str) -> str:
    return f"try_strptime({column}, '%Y-%m-%d %H:%M:%S')"


HEART = "case when heart_rate_bpm between 40 and 250 then heart_rate_bpm end"
BATTERY = "case when battery_level_pct between 0 and 100 then battery_level_pct else -1 end"
STEPS = "case when steps_count >= 0 then steps_count else 0 end"

LOW_BATTERY = "coalesce(battery_level_pct <= 15, false)"
CARDIAC = """case when heart_rate_bpm > 220 then 'high/distress'
    when heart_rate_bpm between 1 and 89 then 'bradycardia/low'
    when heart_rate_bpm = -1 then 'sensor error'
    else 'normal' end"""

AGE = f"cast(date_diff('year', birth_date, date '{AS_OF}') as int)"
HUMAN_AGE = """cast(case age_years when 0 then 0 when 1 then 15 when 2 then 24
    else 24 + 4 * (age_years - 2) end as int)"""
WEIGHT = """case when weight_lbs < 6.5 then 'underweight'
    when weight_lbs <= 11.5 then 'healthy weight'
    when weight_lbs <= 15.0 then 'overweight'
    else 'obese' end"""

SCORE = """cast(100
    - case when avg_heart_rate_bpm not between 80 and 200 then 20 else 0 end
    - case when estimated_sleep_minutes not between 480 and 1100 then 15 else 0 end
    - case when total_daily_steps < 500 then 15 else 0 end
    - case when min_battery_level_pct < 10 then 5 else 0 end as int)"""
CLAMPED = "least(greatest(computed_score, 0), 100)"
CATEGORY = """case when computed_score >= 85 then 'Excellent'
    when computed_score >= 70 then 'Good'
    when computed_score >= 50 then 'Needs Attention'
    else 'Critical Care' end"""


def percent(minutes: str) -> str:
    return f"cast(round({minutes} / 1440.0 * 100, 1) as double)"


def staged(source: str, time: str = "parsed_reading_time") -> str:
    return f"""
    select {key("collar_id", time_text(time))} as reading_id, collar_id, cat_id,
           {time} as reading_time,
           coalesce(heart_rate_bpm, -1) as heart_rate_bpm,
           coalesce(activity_level, 'unknown') as activity_level,
           coalesce(steps_count, 0) as steps_count,
           coalesce(purr_frequency_hz, 0.0) as purr_frequency_hz,
           coalesce(ambient_temp_c, 0.0) as ambient_temp_c,
           battery_level_pct, ingested_at, source_file
    from {source}"""


def measures(source: str) -> str:
    return f"""
    select cat_id, cast(reading_time as date) as reading_date,
           avg(heart_rate_bpm) filter (heart_rate_bpm > 0) as heart,
           cast(sum(steps_count) as bigint) as total_daily_steps,
           avg(purr_frequency_hz) as purr, avg(ambient_temp_c) as temp,
           min(battery_level_pct) as min_battery_level_pct,
           60 * count(*) filter (activity_level = 'sleep') as estimated_sleep_minutes,
           60 * count(*) filter (activity_level = 'active') as estimated_active_minutes,
           60 * count(*) filter (activity_level = 'lazy') as estimated_lazy_minutes,
           count(*) as total_readings_logged
    from {source} group by all"""


def daily(source: str) -> str:
    return f"""
    select {key("cat_id", "cast(reading_date as string)")} as daily_summary_id,
           cat_id, reading_date,
           {rounded("heart", 1, 6)} as avg_heart_rate_bpm, total_daily_steps,
           {rounded("purr", 2)} as avg_purr_frequency_hz,
           {rounded("temp", 2)} as avg_ambient_temp_c,
           min_battery_level_pct, estimated_sleep_minutes, estimated_active_minutes,
           estimated_lazy_minutes, total_readings_logged
    from {source}"""


def health(source: str) -> str:
    return f"""
    select daily_summary_id, cat_id, reading_date, avg_heart_rate_bpm, total_daily_steps,
           avg_purr_frequency_hz, estimated_sleep_minutes, estimated_active_minutes,
           estimated_lazy_minutes, {CLAMPED} as daily_feline_health_score,
           {CATEGORY} as health_status_category
    from (select *, {SCORE} as computed_score from {source})"""


def flat(days: str) -> str:
    return f"""
    select h.daily_summary_id, c.cat_id, c.cat_name, c.breed, c.gender, c.age_years,
           c.human_equivalent_age, c.weight_lbs, c.weight_category,
           h.* exclude (daily_summary_id, cat_id),
           {percent("h.estimated_sleep_minutes")} as sleep_percentage_of_day,
           {percent("h.estimated_active_minutes")} as active_percentage_of_day
    from {days} h left join dim c on c.cat_id = h.cat_id"""


HOUR_TEXT = "strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S')"

TABLES = {
    "raw": f"select {RAW_COLUMNS.format(hour_text=HOUR_TEXT)} from events",
    "registry": f"select {REGISTRY_COLUMNS} from customer",
    "cleaned": f"""
    select * replace ({HEART} as heart_rate_bpm, {BATTERY} as battery_level_pct,
                      {STEPS} as steps_count),
           {parsed("reading_time")} as parsed_reading_time
    from raw""",
    "dedup": """
    select * from cleaned
    qualify row_number() over (partition by collar_id, parsed_reading_time
                               order by ingested_at desc, source_file desc) = 1""",
    "silver": "select d.*, r.* exclude (cat_id) from dedup d join registry r on r.cat_id = d.cat_id",
    "staged": staged("silver"),
    "raw_timed": f"select *, {parsed('reading_time')} as parsed_reading_time from raw",
    "raw_staged": staged("raw_timed"),
    "fact": f"""
    select * exclude (ingested_at, source_file),
           {LOW_BATTERY} as low_battery_warning, {CARDIAC} as cardiac_status
    from staged""",
    "stg_registry": """
    select cat_id, trim(name) as cat_name, coalesce(trim(breed), 'Mixed Breed') as breed,
           lower(gender) as gender, birth_date, weight_lbs, owner_id, registered_at
    from registry""",
    "dim": f"""
    select * exclude (owner_id, registered_at), {HUMAN_AGE} as human_equivalent_age,
           {WEIGHT} as weight_category, owner_id, registered_at
    from (select *, {AGE} as age_years from stg_registry)""",
    "measures": measures("staged"),
    "daily": daily("measures"),
    "health": health("daily"),
    "bi": flat("health"),
    "shown": "select * from bi where reading_date is not null",
    "unregistered_staged": staged("dedup"),
    "unregistered_measures": measures("unregistered_staged"),
    "unregistered_daily": daily("unregistered_measures"),
    "unregistered_health": health("unregistered_daily"),
    "unmatched_bi": flat("unregistered_health"),
    "unmatched_shown": "select * from unmatched_bi where reading_date is not null",
    "raw_measures": measures("raw_staged"),
    "raw_daily": daily("raw_measures"),
    "raw_health": health("raw_daily"),
}

CHAIN = ",\n".join(f"{name} as ({sql})" for name, sql in TABLES.items())


def oracle(sql: str) -> str:
    return f"with {CHAIN}\n{sql.strip()}"
