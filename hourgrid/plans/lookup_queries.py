"""Queries on last-known values, fallbacks, stations and set lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.dimensions import CITIES
from hourgrid.operators import lookups, quality, regression, stations
from hourgrid.functions.index import clip_index, pm25_to_aqi
from hourgrid.plans.bindings import (
    HOURLY_CTE, KEYS, WEATHER_CTE, hourly, hourly_plan, index_sql, readings, table, weather, weather_plan, with_ctes)
from hourgrid.plans.catalog import query
from hourgrid.session import saved
from hourgrid.sources.stores import split_range_union

AS_OF = "2024-01-25 12:30:00"


def _moment():
    return F.lit(AS_OF).cast("timestamp_ntz")


@query("last_known", with_ctes(HOURLY_CTE) + f"""
SELECT city, max(ts) AS ts, arg_max(aqi, ts) AS aqi FROM hourly WHERE ts <= TIMESTAMP '{AS_OF}' GROUP BY city""")
def _(spark, sf):
    return lookups.last_known(hourly_plan(spark, sf), KEYS, "ts", ["aqi"], _moment())


@query("latest_per_sensor", f"""
SELECT user_id AS station, max(ts) AS ts, arg_max(value, (ts, value)) AS pm25,
 (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(ts)))/3.6e9::DOUBLE AS age_hours, {index_sql('arg_max(value, (ts, value))')} AS aqi,
 greatest(arg_max(coalesce(k, -1), (ts, value, coalesce(k, -1))), 0)::DOUBLE AS coverage_pct
FROM (SELECT *, nullif((props->>'$.k')::BIGINT, 0) AS k FROM events) WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND ts <= TIMESTAMP '{AS_OF}' GROUP BY 1""")
def _(spark, sf):
    """A reading's coverage is the property k of its event; 0 stands for unknown."""
    rows = table(spark, sf, "events").select(
        F.col("user_id").alias("station"), "ts", F.col("value").alias("pm25"),
        F.nullif(F.get_json_object("props", "$.k").try_cast("bigint"), F.lit(0)).alias("coverage_pct"))
    return stations.latest_per_sensor(rows, ["station"], "ts", "pm25", _moment(), coverage="coverage_pct")


@query("as_of_weather", with_ctes(WEATHER_CTE) + """
SELECT e.event_id, e.event_type AS city, w.ts AS matched_ts, round(w.temperature_2m, 9) AS temperature_2m
FROM events e ASOF LEFT JOIN weather w ON e.event_type = w.city AND e.ts >= w.ts""")
def _(spark, sf):
    left = readings(spark, sf).select("city", "ts", "event_id")
    out = lookups.as_of_join(left, weather(spark, sf), KEYS, "ts", ["temperature_2m"])
    return out.select("event_id", "city", "matched_ts", F.round("temperature_2m", 9).alias("temperature_2m"))


RECENT_DAYS_CTE = """days AS (SELECT DISTINCT city, date_trunc('day', ts) AS d FROM hourly),
newest AS (SELECT city, d FROM (SELECT *, dense_rank() OVER (PARTITION BY city ORDER BY d DESC) AS r FROM days) WHERE r <= 7),
recent AS (SELECT h.* FROM hourly h JOIN newest n ON h.city = n.city AND date_trunc('day', h.ts) = n.d)"""


@query("recent_means", with_ctes(HOURLY_CTE, RECENT_DAYS_CTE) + "SELECT city, round(avg(aqi), 9) AS aqi FROM recent GROUP BY city")
def _(spark, sf):
    out = lookups.recent_mean(hourly(spark, sf), KEYS, "ts", ["aqi"])
    return out.withColumn("aqi", F.round("aqi", 9))


@query("fallback_chain", f"""
WITH r AS (SELECT user_id AS station, ts, value FROM events),
series AS (SELECT station FROM r UNION SELECT s_suppkey FROM supplier),
live AS (SELECT station, arg_max(value, (ts, value)) AS v FROM r WHERE ts >= TIMESTAMP '{AS_OF}' GROUP BY station),
last AS (SELECT station, arg_max(value, (ts, value)) AS v FROM r WHERE ts <= TIMESTAMP '{AS_OF}' GROUP BY station),
days AS (SELECT DISTINCT station, date_trunc('day', ts) AS d FROM r),
newest AS (SELECT station, d FROM days QUALIFY dense_rank() OVER (PARTITION BY station ORDER BY d DESC) <= 7),
mean AS (SELECT r.station, avg(r.value) AS v FROM r JOIN newest n ON r.station = n.station AND date_trunc('day', r.ts) = n.d GROUP BY 1)
SELECT station, round(coalesce(live.v, last.v, mean.v, 100), 9) AS value,
 CASE WHEN live.v IS NOT NULL THEN 'live' WHEN last.v IS NOT NULL THEN 'last_known' WHEN mean.v IS NOT NULL THEN 'recent_mean' ELSE 'default' END AS source
FROM series LEFT JOIN live USING (station) LEFT JOIN last USING (station) LEFT JOIN mean USING (station)""")
def _(spark, sf):
    """Stations by their own gaps: some are silent after the moment, some suppliers never report."""
    rows = readings(spark, sf).select("station", "ts", F.col("pm25").alias("value"))
    registered = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("station"))
    live = lookups.last_known(rows.filter(F.col("ts") >= _moment()), ["station"], "ts", ["value"])
    last = lookups.last_known(rows, ["station"], "ts", ["value"], _moment())
    mean = lookups.recent_mean(rows, ["station"], "ts", ["value"])
    out = lookups.fallback_value(rows.select("station").union(registered).distinct(), live, last, mean, ["station"])
    return out.withColumn("value", F.round("value", 9))


@query("known_cities", """
SELECT user_id AS station, count(*)::BIGINT AS events FROM events WHERE user_id IN (SELECT s_suppkey FROM supplier) GROUP BY 1""")
def _(spark, sf):
    registered = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("station"))
    requested = readings(spark, sf).groupBy("station").agg(F.count(F.lit(1)).alias("events"))
    return lookups.known(requested, registered, ["station"])


@query("unknown_cities", """
SELECT DISTINCT user_id AS station FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""")
def _(spark, sf):
    registered = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("station"))
    return lookups.unknown(readings(spark, sf).select("station").distinct(), registered, ["station"])


@query("requested_and_known", """
SELECT user_id AS station FROM events INTERSECT SELECT s_suppkey FROM supplier""")
def _(spark, sf):
    registered = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("station"))
    return readings(spark, sf).select("station").intersect(registered)


@query("first_live_sensor", """
SELECT location, arg_min(sensor, sensor) AS sensor, arg_min(latest, sensor) AS latest FROM (
 SELECT l_suppkey AS location, l_partkey AS sensor, max(l_shipdate)::DATE AS latest FROM lineitem GROUP BY ALL)
WHERE year(latest) >= 2000 GROUP BY location""")
def _(spark, sf):
    items = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("location"), F.col("l_partkey").alias("sensor"), "l_shipdate")
    return stations.first_live_sensor(items, "location", "sensor", "l_shipdate", since_year=2000)


@query("active_sensor", """
SELECT l_suppkey AS location, max(l_partkey) AS sensor, count(*)::BIGINT AS candidates FROM lineitem GROUP BY 1""")
def _(spark, sf):
    items = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("location"), F.col("l_partkey").alias("sensor"))
    return stations.active_sensor(items, "location", "sensor")


CITY_VALUES = ", ".join(f"('{c[0]}', {c[1]}::DOUBLE, {c[2]}::DOUBLE)" for c in CITIES)


@query("bbox_stations", f"""
WITH cities(city, lat, lon) AS (VALUES {CITY_VALUES}),
st AS (SELECT c_custkey AS station, c_acctbal/400 + 8 AS station_lat, (c_custkey*0.7::DOUBLE) % 29 + 68 AS station_lon FROM customer)
SELECT city, station FROM cities JOIN st ON station_lat BETWEEN lat - 0.5::DOUBLE AND lat + 0.5::DOUBLE
 AND station_lon BETWEEN lon - 0.5::DOUBLE AND lon + 0.5::DOUBLE""")
def _(spark, sf):
    from hourgrid.dimensions import cities

    located = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("station"), (F.col("c_acctbal") / 400 + 8).alias("station_lat"),
        ((F.col("c_custkey") * 0.7) % 29 + 68).alias("station_lon"))
    return stations.stations_in_boxes(cities(spark).select("city", "lat", "lon"), located).select("city", "station")


@query("index_range_join", f"""
SELECT event_id, coalesce(b.lo, -1) AS band_low, c.label FROM (SELECT event_id, value, {index_sql('value')} AS aqi FROM events) e
LEFT JOIN (VALUES (0.0::DOUBLE, 12.0::DOUBLE, 0), (12.1, 35.4, 51), (35.5, 55.4, 101), (55.5, 150.4, 151), (150.5, 250.4, 201), (250.5, 500.4, 301)) b(cl, ch, lo)
 ON e.value BETWEEN b.cl AND b.ch
JOIN (VALUES (0, 50, 'Good'), (51, 100, 'Satisfactory'), (101, 200, 'Moderate'), (201, 300, 'Poor'), (301, 400, 'Very Poor'), (401, 500, 'Severe')) c(l, h, label)
 ON e.aqi BETWEEN c.l AND c.h""")
def _(spark, sf):
    """The band tables as rows; six rows each, so a broadcast range join is bounded."""
    from hourgrid.dimensions import breakpoints, categories

    rows = table(spark, sf, "events").select("event_id", "value", pm25_to_aqi(F.col("value")).alias("aqi"))
    banded = rows.join(F.broadcast(breakpoints(spark)), F.col("value").between(F.col("c_low"), F.col("c_high")), "left")
    named = banded.join(F.broadcast(categories(spark)), F.col("aqi").between(F.col("low"), F.col("high")))
    return named.select("event_id", F.coalesce("i_low", F.lit(-1)).alias("band_low"), "label")


@query("freshness", f"""
WITH st AS (SELECT DISTINCT event_type AS city, user_id AS station FROM events),
latest AS (SELECT event_type AS city, user_id AS station, max(ts) AS ts FROM events
 WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND ts <= TIMESTAMP '{AS_OF}' GROUP BY ALL)
SELECT city, count(ts)::BIGINT AS working, count(*)::BIGINT AS total,
 min((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts))/3.6e9::DOUBLE) AS newest_age_hours FROM st LEFT JOIN latest USING (city, station) GROUP BY city""")
def _(spark, sf):
    rows = readings(spark, sf)
    latest = stations.latest_per_sensor(rows, ["city", "station"], "ts", "pm25", _moment())
    return stations.freshness(rows.select("city", "station").distinct(), latest, KEYS, "station", "pm25")


@query("station_consensus", f"""
WITH sh0 AS (SELECT event_type AS city, user_id AS station, date_trunc('hour', ts)::TIMESTAMP AS ts,
  sum(round(value*100)::BIGINT)::DOUBLE/(count(value)*100)::DOUBLE AS pm25 FROM events GROUP BY ALL),
sh AS (SELECT *, {index_sql('pm25')} AS aqi FROM sh0),
v AS (SELECT *, row_number() OVER (PARTITION BY city, ts ORDER BY aqi, station) - 1 AS i, count(*) OVER (PARTITION BY city, ts) AS n FROM sh WHERE aqi > 0),
m AS (SELECT city, ts, max(CASE WHEN i = n // 2 THEN aqi END) AS median_aqi, max(n)::BIGINT AS stations_used, min(aqi) || '-' || max(aqi) AS aqi_range FROM v GROUP BY ALL)
SELECT city, ts, median_aqi, stations_used, aqi_range, nearest_station, round(pm25, 9) AS pm25 FROM (
 SELECT m.*, v.station AS nearest_station, v.pm25, row_number() OVER (PARTITION BY city, ts ORDER BY abs(v.aqi - median_aqi), v.station) AS r
 FROM m JOIN v USING (city, ts)) WHERE r = 1""")
def _(spark, sf):
    from hourgrid.operators.rollup import station_hour_rollup

    hours = station_hour_rollup(readings(spark, sf), ["city", "station"], decimals=2)
    out = stations.consensus(hours, ["city", "ts"], "station", "aqi", ["pm25"])
    return out.withColumn("pm25", F.round("pm25", 9))


@query("range_split_union", with_ctes(HOURLY_CTE) + """
, cut AS (SELECT TIMESTAMP '2024-01-20 00:00:00' AS c),
u AS (SELECT city, ts, pm25 AS v, 0 AS side FROM hourly, cut WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= c
 UNION ALL SELECT city, ts, pm25 + 1000, 1 FROM hourly, cut WHERE ts >= c AND ts <= TIMESTAMP '2024-01-28 00:00:00')
SELECT city, ts, round(v, 9) AS v FROM (SELECT *, row_number() OVER (PARTITION BY city, ts ORDER BY side) AS r FROM u) WHERE r = 1""")
def _(spark, sf):
    hours = hourly(spark, sf).select("city", "ts", F.col("pm25").alias("v"))
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    out = split_range_union(hours, hours.withColumn("v", F.col("v") + 1000), KEYS, "ts",
                            at("2024-01-05 00:00:00"), at("2024-01-28 00:00:00"), at("2024-01-25 00:00:00"))
    return out.withColumn("v", F.round("v", 9))


@query("regressor_assembly", with_ctes(HOURLY_CTE, WEATHER_CTE) + """
SELECT city, ts, round(coalesce(temperature_2m, avg(temperature_2m) OVER (PARTITION BY city), 0), 9) AS temperature_2m,
 0.0::DOUBLE AS humidity FROM hourly LEFT JOIN weather USING (city, ts)""")
def _(spark, sf):
    joined = saved(hourly_plan(spark, sf).join(weather_plan(spark, sf), ["city", "ts"], "left"), "joined")
    out = regression.assemble_regressors(joined, KEYS, "ts", ["temperature_2m", "humidity"])
    return out.withColumn("temperature_2m", F.round("temperature_2m", 9))


@query("clip_and_fill", with_ctes(HOURLY_CTE, WEATHER_CTE) + """
, j AS (SELECT city, ts, temperature_2m, ts > TIMESTAMP '2024-01-23 00:00:00' AS test FROM hourly LEFT JOIN weather USING (city, ts)),
m AS (SELECT city, avg(coalesce(temperature_2m, 0)) AS tm FROM j WHERE NOT test GROUP BY city)
SELECT city, ts, round(coalesce(temperature_2m, tm, 0), 9) AS temperature_2m,
 round(least(greatest(coalesce(temperature_2m, tm, 0)*12 - 100, 0), 500), 9) AS clipped FROM j JOIN m USING (city) WHERE test""")
def _(spark, sf):
    joined = saved(hourly_plan(spark, sf).join(weather_plan(spark, sf), ["city", "ts"], "left").select(
        "city", "ts", "temperature_2m"), "joined")
    cut = F.lit("2024-01-23 00:00:00").cast("timestamp_ntz")
    filled = regression.fill_with_train_mean(joined.filter(F.col("ts") > cut), joined.filter(F.col("ts") <= cut),
                                             KEYS, ["temperature_2m"])
    t = F.col("temperature_2m")
    return filled.select("city", "ts", F.round(t, 9).alias("temperature_2m"),
                         F.round(clip_index(t * 12 - 100), 9).alias("clipped"))


@query("regressor_availability", with_ctes(HOURLY_CTE, WEATHER_CTE) + """
, j AS (SELECT * FROM hourly LEFT JOIN weather USING (city, ts))
SELECT 'temperature_2m' AS regressor, count(temperature_2m)::BIGINT AS non_null, count(temperature_2m) > 0 AS available FROM j
UNION ALL SELECT 'temp_inversion', 0::BIGINT, false""")
def _(spark, sf):
    joined = hourly_plan(spark, sf).join(weather_plan(spark, sf), ["city", "ts"], "left")
    joined = quality.with_missing_as_null(joined, ["temp_inversion"])
    return regression.regressor_availability(joined, ["temperature_2m", "temp_inversion"])
