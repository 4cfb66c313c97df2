"""Fixed values and the small dimension tables built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Cities (name, lat, lon, country, timezone, station ids, profile)
# ---------------------------------------------------------------------------
CITIES = [
    ("Delhi", 28.6139, 77.2090, "India", "Asia/Kolkata",
     [6358, 11603, 8118, 5613, 6929, 5610, 8917, 6359, 6934, 8365, 5627], "severe_winter"),
    ("Mumbai", 19.0760, 72.8777, "India", "Asia/Kolkata",
     [3409482, 3409486, 6987, 12024, 6948, 6956, 6945, 3409514, 6967, 3409511,
      3409329, 3409483, 3409513, 6959, 3409323], "coastal_moderate"),
    ("Kolkata", 22.5726, 88.3639, "India", "Asia/Kolkata",
     [10633, 6981, 10918, 3409524, 10904, 5614, 6946, 3409320, 6950], "industrial_high"),
    ("Chennai", 13.0827, 80.2707, "India", "Asia/Kolkata",
     [11578, 11579, 2586, 10780, 11581, 5655, 12046], "coastal_low"),
    ("Bengaluru", 12.9716, 77.5946, "India", "Asia/Kolkata",
     [6974, 3409385, 3409393, 5607, 6984, 6983, 6973, 5548, 6975, 3409388], "traffic_moderate"),
]

# Accepted spellings (lower case) of each city in history files
CITY_ALIASES = [
    ("delhi", "Delhi"),
    ("new delhi", "Delhi"),
    ("mumbai", "Mumbai"),
    ("kolkata", "Kolkata"),
    ("calcutta", "Kolkata"),
    ("chennai", "Chennai"),
    ("bengaluru", "Bengaluru"),
    ("bangalore", "Bengaluru"),
]

# Index categories (low, high, label, colour, advice)
AQI_CATEGORIES = [
    (0, 50, "Good", "#00b050", "No health implications."),
    (51, 100, "Satisfactory", "#92d050", "Minor breathing discomfort to sensitive people."),
    (101, 200, "Moderate", "#ffff00", "Breathing discomfort to people with lung/heart disease."),
    (201, 300, "Poor", "#ff9900", "Breathing discomfort to most people on prolonged exposure."),
    (301, 400, "Very Poor", "#ff0000", "Respiratory illness on prolonged exposure."),
    (401, 500, "Severe", "#c00000", "Affects healthy people. Serious impact on those with disease."),
]

# Concentration breakpoints (c_low, c_high, index_low, index_high)
PM25_BREAKPOINTS = [
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 500.4, 301, 500),
]
INDEX_CAP = 500

# Category boundaries used by the boundary-error metrics
CATEGORY_BOUNDARIES = [50, 100, 200, 300, 400]

# Weather variables, history-file renames, optional extras
WEATHER_COLS = [
    "temperature_2m",
    "wind_speed_10m",
    "wind_direction_10m",
    "relative_humidity_2m",
    "precipitation",
    "surface_pressure",
]
BONUS_COLS = ["temp_inversion", "crop_burning", "festival_period"]
WEATHER_RENAMES = {
    "Temp_2m_C": "temperature_2m",
    "Wind_Speed_10m_kmh": "wind_speed_10m",
    "Wind_Dir_10m": "wind_direction_10m",
    "Humidity_Percent": "relative_humidity_2m",
    "Precipitation_mm": "precipitation",
    "Pressure_MSL_hPa": "surface_pressure",
}
BONUS_RENAMES = {
    "Temp_Inversion": "temp_inversion",
    "Crop_Burning_Season": "crop_burning",
    "Festival_Period": "festival_period",
    "Season": "season",
}
HISTORY_REQUIRED = ["Datetime", "City", "PM2_5_ugm3", *WEATHER_RENAMES]

# Feature windows, calendar effects, regressors
LAG_HOURS = [1, 2, 3, 24, 48, 168]
ROLLING_WINDOWS = [(6, "6h"), (24, "24h"), (168, "7d")]
RUSH_HOURS = [(7, 10), (17, 20)]
CROP_BURNING_MONTHS = [10, 11]
FESTIVAL_WEIGHTS = {10: 0.55, 11: 0.50}
REGRESSORS = [
    "wind_speed_10m",
    "temperature_2m",
    "relative_humidity_2m",
    "aqi_lag_24h",
    "aqi_roll_mean_24h",
    "is_rush_hour",
]

# thresholds
WIND_KMH_MEAN = 15.0
KMH_PER_MS = 3.6
MIN_COVERAGE_PCT = 50
PM25_MIN, PM25_MAX = 0, 999
DRIFT_ALPHA = 0.05
DRIFT_MIN_SAMPLES = 24
MONTH_MIN_ROWS = 100
BOUNDARY_MARGIN = 10
MAE_ACCEPTANCE = 50
MAX_BACKFILL_DAYS = 730
BACKFILL_CHUNK_DAYS = 30
DEFAULT_INDEX = 100.0

# Monitoring rules (name, threshold, range seconds, hold seconds)
ALERT_RULES = {
    "HighErrorRate": (0.05, 300, 300),
    "SlowResponseTime": (10.0, 300, 300),
    "HighRequestRate": (100.0, 60, 120),
    "TargetDown": (0.0, 0, 60),
}

CITY_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("station_ids", T.ArrayType(T.LongType())),
    T.StructField("profile", T.StringType()),
])


def cities(spark: SparkSession) -> DataFrame:
    """The city dimension; a handful of rows, safe to broadcast."""
    return spark.createDataFrame(CITIES, CITY_SCHEMA)


def categories(spark: SparkSession) -> DataFrame:
    """The category bands as rows, for range joins against a band table."""
    return spark.createDataFrame(
        AQI_CATEGORIES, "low int, high int, label string, color string, advice string")


def breakpoints(spark: SparkSession) -> DataFrame:
    """The concentration breakpoints as rows, for range joins."""
    return spark.createDataFrame(
        PM25_BREAKPOINTS, "c_low double, c_high double, i_low int, i_high int")
