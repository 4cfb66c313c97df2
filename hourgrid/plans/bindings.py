"""How the given tables play the roles of readings, weather, requests and registries.

Each binding reads only the columns its role needs, so pruning reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.index import pm25_to_aqi
from hourgrid.functions.timefns import floor_hour
from hourgrid.operators.rollup import hourly_mean, mean_of
from hourgrid.session import saved

KEYS = ["city"]
AS_OF = "2024-01-31 00:00:00"


# Schemas of the tables in use: given, so that planning reads no file footers
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                " l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """events as readings: event type = city, user = station, value = concentration."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("city"), F.col("user_id").alias("station"), "ts",
        F.col("value").alias("pm25"), "event_id")


def hourly_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly mean concentration per city and its index (one row per city and hour)."""
    rows = hourly_mean(readings(spark, sf), KEYS, "ts", "pm25", decimals=2)
    return rows.withColumn("aqi", pm25_to_aqi(F.col("pm25"))).drop("n")


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly readings as a table of their own, for plans that use them more than once."""
    return saved(hourly_plan(spark, sf), "hourly")


def weather_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Weather per city and hour: the property k of every event, announced one hour ahead.

    So some hours with readings have no weather, and the other way round.
    """
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("city"), k.alias("k"),
        (floor_hour(F.col("ts")) + F.expr("INTERVAL 1 HOUR")).alias("ts"))
    return rows.groupBy("city", "ts").agg(
        mean_of("k", 0).alias("temperature_2m"), F.max("k").cast("double").alias("wind_speed_10m"))


def weather(spark: SparkSession, sf: str) -> DataFrame:
    return saved(weather_plan(spark, sf), "weather")


def daily_plan(spark: SparkSession, sf: str) -> DataFrame:
    """A multi-year daily series per order priority: mean order value as a whole number."""
    rows = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("city"), F.col("o_orderdate").alias("ds"), "o_totalprice")
    return rows.groupBy("city", "ds").agg(
        F.rint(mean_of("o_totalprice", 2)).alias("y"))


def daily_orders(spark: SparkSession, sf: str) -> DataFrame:
    return saved(daily_plan(spark, sf), "daily")


# ---- the same bindings in SQL, as common table expressions ----------------

INDEX_SQL = """(CASE WHEN {v} IS NULL THEN NULL WHEN {v} < 0 THEN 0
 WHEN {v} BETWEEN 0 AND 12.0::DOUBLE THEN round_even((50::DOUBLE/12.0::DOUBLE)*({v}-0)+0, 0)
 WHEN {v} BETWEEN 12.1::DOUBLE AND 35.4::DOUBLE THEN round_even((49::DOUBLE/(35.4::DOUBLE-12.1::DOUBLE))*({v}-12.1::DOUBLE)+51, 0)
 WHEN {v} BETWEEN 35.5::DOUBLE AND 55.4::DOUBLE THEN round_even((49::DOUBLE/(55.4::DOUBLE-35.5::DOUBLE))*({v}-35.5::DOUBLE)+101, 0)
 WHEN {v} BETWEEN 55.5::DOUBLE AND 150.4::DOUBLE THEN round_even((49::DOUBLE/(150.4::DOUBLE-55.5::DOUBLE))*({v}-55.5::DOUBLE)+151, 0)
 WHEN {v} BETWEEN 150.5::DOUBLE AND 250.4::DOUBLE THEN round_even((99::DOUBLE/(250.4::DOUBLE-150.5::DOUBLE))*({v}-150.5::DOUBLE)+201, 0)
 WHEN {v} BETWEEN 250.5::DOUBLE AND 500.4::DOUBLE THEN round_even((199::DOUBLE/(500.4::DOUBLE-250.5::DOUBLE))*({v}-250.5::DOUBLE)+301, 0)
 ELSE 500 END)::INTEGER"""

LABEL_SQL = """(CASE WHEN {v} IS NULL THEN NULL
 WHEN trunc({v}) BETWEEN 0 AND 50 THEN 'Good' WHEN trunc({v}) BETWEEN 51 AND 100 THEN 'Satisfactory'
 WHEN trunc({v}) BETWEEN 101 AND 200 THEN 'Moderate' WHEN trunc({v}) BETWEEN 201 AND 300 THEN 'Poor'
 WHEN trunc({v}) BETWEEN 301 AND 400 THEN 'Very Poor' ELSE 'Severe' END)"""


def index_sql(v: str) -> str:
    return INDEX_SQL.format(v=v)


def label_sql(v: str) -> str:
    return LABEL_SQL.format(v=v)


READINGS_CTE = """readings AS (
 SELECT event_type AS city, user_id AS station, ts, value AS pm25, event_id FROM events)"""

HOURLY_CTE = f"""hourly0 AS (
 SELECT event_type AS city, date_trunc('hour', ts)::TIMESTAMP AS ts,
  sum(round(value*100)::BIGINT)::DOUBLE / (count(value)*100)::DOUBLE AS pm25, count(value) AS n
 FROM events GROUP BY ALL),
hourly AS (SELECT city, ts, pm25, {index_sql('pm25')} AS aqi FROM hourly0)"""

# the complete grid of every city, cut at the hour before the closing midnight
GRID_CTE = """bounds AS (
 SELECT city, date_trunc('day', min(ts))::TIMESTAMP AS g0,
  (CASE WHEN max(ts) = date_trunc('day', max(ts)) THEN max(ts)
   ELSE date_trunc('day', max(ts)) + INTERVAL 1 DAY END - INTERVAL 1 HOUR)::TIMESTAMP AS g1
 FROM hourly GROUP BY city),
hours AS (SELECT city, unnest(generate_series(g0, g1, INTERVAL 1 HOUR))::TIMESTAMP AS ts FROM bounds),
grid AS (SELECT h.city, h.ts, r.pm25, r.aqi FROM hours h LEFT JOIN hourly r USING (city, ts))"""

WEATHER_CTE = """weather AS (
 SELECT event_type AS city, (date_trunc('hour', ts) + INTERVAL 1 HOUR)::TIMESTAMP AS ts,
  sum((props->>'$.k')::BIGINT)::DOUBLE / count((props->>'$.k')::BIGINT)::DOUBLE AS temperature_2m,
  max((props->>'$.k')::BIGINT)::DOUBLE AS wind_speed_10m
 FROM events GROUP BY ALL)"""

DAILY_CTE = """daily AS (
 SELECT o_orderpriority AS city, o_orderdate AS ds,
  round_even(sum(round(o_totalprice*100)::BIGINT)::DOUBLE / (count(o_totalprice)*100)::DOUBLE, 0) AS y
 FROM orders GROUP BY ALL)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
