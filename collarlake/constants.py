"""Fixed values that results depend on."""

# Text pattern of a raw reading time.
READING_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"

# Inclusive ranges a sensor value must lie in to be kept.
HEART_RATE_MIN, HEART_RATE_MAX = 40, 250
BATTERY_MIN, BATTERY_MAX = 0, 100

# What stands in for a missing value.
MISSING_SENSOR = -1
UNKNOWN_ACTIVITY = "unknown"
DEFAULT_BREED = "Mixed Breed"

# Activity labels, and minutes one reading stands for.
SLEEP, ACTIVE, LAZY = "sleep", "active", "lazy"
MINUTES_PER_READING = 60
MINUTES_PER_DAY = 1440.0

# Surrogate key layout, a NULL's token and a timestamp's text.
KEY_SEPARATOR = "-"
KEY_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSS"

# Weight class limits in pounds.
UNDERWEIGHT_BELOW = 6.5
HEALTHY_UP_TO = 11.5
OVERWEIGHT_UP_TO = 15.0

# Human-equivalent age.
HUMAN_AGE_FIRST_YEARS = {0: 0, 1: 15, 2: 24}
HUMAN_YEARS_PER_LATER_YEAR = 4

# Flags on single readings.
LOW_BATTERY_AT = 15
DISTRESS_ABOVE = 220
BRADYCARDIA_BELOW = 90

# Daily health score, limits and penalties.
SCORE_BASE = 100
SCORE_HEART_LOW, SCORE_HEART_HIGH, HEART_PENALTY = 80, 200, 20
SCORE_SLEEP_LOW, SCORE_SLEEP_HIGH, SLEEP_PENALTY = 480, 1100, 15
SCORE_STEPS_LOW, STEPS_PENALTY = 500, 15
SCORE_BATTERY_LOW, BATTERY_PENALTY = 10, 5

# Health categories by lowest score, best first.
HEALTH_CATEGORIES = ((85, "Excellent"), (70, "Good"), (50, "Needs Attention"))
HEALTH_WORST = "Critical Care"

# Dashboard baselines and heart-rate gauge zones.
BASELINE_STEPS, BASELINE_SLEEP_MINUTES, TARGET_SCORE = 3000, 840, 75
GAUGE_NORMAL_FROM, GAUGE_NORMAL_TO = 100, 180
ALL_CATS = "All Cats"

# Tokens the registry load reads as NULL.
CSV_NULL_TOKENS = ("NULL", "null", "")
