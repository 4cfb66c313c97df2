"""Explicit schemas of every external format (structs, or DDL text for ``from_json``)."""

from pyspark.sql import types as T

RAW_READING = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("pm25", T.DoubleType()),
    T.StructField("pm25_min", T.DoubleType()),
    T.StructField("pm25_max", T.DoubleType()),
    T.StructField("pm25_sd", T.DoubleType()),
    T.StructField("coverage_pct", T.DoubleType()),
    T.StructField("aqi", T.IntegerType()),
    T.StructField("city", T.StringType()),
    T.StructField("location_id", T.LongType()),
])

HISTORY_CSV = T.StructType([T.StructField(c, T.StringType()) for c in (
    "Datetime", "City", "PM2_5_ugm3", "Temp_2m_C", "Wind_Speed_10m_kmh", "Wind_Dir_10m",
    "Humidity_Percent", "Precipitation_mm", "Pressure_MSL_hPa", "Temp_Inversion",
    "Crop_Burning_Season", "Festival_Period", "Season")])

MEASUREMENT_FIELDS = (
    "value:double, period:struct<datetimeTo:struct<utc:string>>,"
    " coverage:struct<percentCoverage:double>, flagInfo:struct<hasFlags:boolean>,"
    " summary:struct<min:double,max:double,sd:double>")
MEASUREMENT_PAGE = f"results array<struct<{MEASUREMENT_FIELDS}>>"

SENSOR_PAGE = "results array<struct<id:bigint, parameter:struct<name:string>>>"

WEATHER_PAGE = (
    "hourly struct<time:array<string>, temperature_2m:array<double>, wind_speed_10m:array<double>,"
    " wind_direction_10m:array<double>, relative_humidity_2m:array<double>,"
    " precipitation:array<double>, surface_pressure:array<double>>")

LIVE_READING = (
    "status string, data struct<aqi:int, time:struct<s:string,tz:string>,"
    " iaqi:struct<t:struct<v:double>,h:struct<v:double>,w:struct<v:double>,wd:struct<v:double>,"
    "wg:struct<v:double>,p:struct<v:double>,dew:struct<v:double>>>")
