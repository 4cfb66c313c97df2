"""Queries on cleaning, rollups, de-duplication, upserts and backfills."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.functions import timefns as tf
from hourgrid.functions.index import pm25_to_aqi
from hourgrid.operators import backfill, dedupe, quality, rollup
from hourgrid.plans.bindings import (
    AS_OF, KEYS, READINGS_CTE, hourly, index_sql, readings, table, with_ctes, HOURLY_CTE, WEATHER_CTE,
    weather_plan)
from hourgrid.plans.catalog import query


def _k(props="props"):
    return F.get_json_object(props, "$.k").try_cast("double")


@query("quality_filter", """
SELECT event_id, value FROM (SELECT event_id, value, CASE WHEN event_type = 'error' THEN value > 60 END AS flagged,
 CASE WHEN (props->>'$.k')::DOUBLE < 90 THEN (props->>'$.k')::DOUBLE END AS coverage FROM events)
WHERE value IS NOT NULL AND coalesce(coverage, 100) >= 50 AND NOT coalesce(flagged, false) AND value BETWEEN 0 AND 999""")
def _(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "value", F.when(F.col("event_type") == "error", F.col("value") > 60).alias("flagged"),
        F.when(_k() < 90, _k()).alias("coverage"))
    good = quality.quality_filter(rows, "value", "coverage", "flagged")
    return quality.physical_bounds(good, "value").select("event_id", "value")


@query("coerce_parse", """
SELECT event_id, try_cast(stamp AS TIMESTAMP) AS stamp, try_cast(num AS DOUBLE) AS num FROM (
 SELECT event_id, CASE WHEN event_type = 'error' THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp,
  CASE WHEN value > 100 THEN 'n/a' ELSE value::VARCHAR END AS num FROM events)
WHERE try_cast(stamp AS TIMESTAMP) IS NOT NULL AND try_cast(num AS DOUBLE) IS NOT NULL""")
def _(spark, sf):
    text = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "not a date").otherwise(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("stamp"),
        F.when(F.col("value") > 100, "n/a").otherwise(F.col("value").cast("string")).alias("num"))
    return quality.coerce(text, ["num"], {"stamp": "yyyy-MM-dd HH:mm:ss"}, ["stamp", "num"])


ALIASES = [("error", "Failure"), ("err", "Failure"), ("click", "Click"), ("tap", "Click"),
           ("view", "View"), ("signup", "Signup")]


@query("alias_normalise", """
SELECT event_id, CASE lower(trim(raw)) WHEN 'error' THEN 'Failure' WHEN 'err' THEN 'Failure' WHEN 'click' THEN 'Click'
 WHEN 'tap' THEN 'Click' WHEN 'view' THEN 'View' WHEN 'signup' THEN 'Signup' END AS city
FROM (SELECT event_id, '  ' || upper(event_type) || ' ' AS raw FROM events)
WHERE lower(trim(raw)) IN ('error', 'err', 'click', 'tap', 'view', 'signup')""")
def _(spark, sf):
    raw = table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("  "), F.upper("event_type"), F.lit(" ")).alias("city"))
    return quality.normalise_aliases(raw, "city", ALIASES)


@query("unit_convert", """
SELECT event_id, round(value/3.6::DOUBLE, 9) AS wind_speed_10m FROM events""")
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.col("value").alias("Wind_Speed_10m_kmh"))
    renamed = quality.rename_weather(rows)
    return renamed.withColumn("wind_speed_10m", F.round(quality.kmh_to_ms(F.col("wind_speed_10m")), 9))


STATION_SQL = with_ctes(READINGS_CTE) + f""", sh0 AS (
 SELECT city, station, date_trunc('hour', ts)::TIMESTAMP AS ts,
  sum(round(pm25*100)::BIGINT)::DOUBLE/(count(pm25)*100)::DOUBLE AS pm25, min(pm25) AS pm25_min, max(pm25) AS pm25_max
 FROM readings GROUP BY ALL),
sh AS (SELECT *, NULL::DOUBLE AS pm25_sd, 100.0::DOUBLE AS coverage_pct, {index_sql('pm25')} AS aqi FROM sh0)
"""


def _station_hours(spark, sf):
    return rollup.station_hour_rollup(readings(spark, sf), ["city", "station"], decimals=2)


@query("station_hour_rollup", STATION_SQL + "SELECT city, station, ts, round(pm25, 9) AS pm25, pm25_min, pm25_max, pm25_sd, coverage_pct, aqi FROM sh")
def _(spark, sf):
    return _station_hours(spark, sf).withColumn("pm25", F.round("pm25", 9))


@query("city_hour_rollup", STATION_SQL + f"""
SELECT city, ts, round(p, 9) AS pm25, lo AS pm25_min, hi AS pm25_max, {index_sql('round(p, 9)')} AS aqi
FROM (SELECT city, ts, avg(pm25) AS p, min(pm25_min) AS lo, max(pm25_max) AS hi FROM sh GROUP BY city, ts)""")
def city_hour_rollup(spark, sf):
    out = rollup.city_hour_rollup(_station_hours(spark, sf), KEYS).withColumn("pm25", F.round("pm25", 9))
    return out.select("city", "ts", "pm25", "pm25_min", "pm25_max", pm25_to_aqi(F.col("pm25")).alias("aqi"))


@query("recent_window_rollup", STATION_SQL + """
SELECT city, ts, round(avg(pm25), 9) AS pm25, round_even(avg(aqi), 0)::INTEGER AS aqi FROM sh
WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-31 00:00:00' GROUP BY city, ts""")
def _(spark, sf):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    out = rollup.recent_window_rollup(_station_hours(spark, sf), KEYS, as_of)
    return out.withColumn("pm25", F.round("pm25", 9))


@query("dedupe_first_wins", """
SELECT city, ts, event_id, value FROM (SELECT event_type AS city, date_trunc('hour', ts)::TIMESTAMP AS ts, event_id, value,
 row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id) AS r FROM events) WHERE r = 1""")
def dedupe_first_wins(spark, sf):
    rows = readings(spark, sf).select("city", tf.floor_hour(F.col("ts")).alias("ts"), "event_id",
                                      F.col("pm25").alias("value"))
    return dedupe.first_wins(rows, ["city", "ts"], [F.col("event_id")])


SIDES_SQL = """WITH rows AS (
 SELECT event_type AS city, date_trunc('hour', ts)::TIMESTAMP AS ts, event_id, value FROM events),
sides AS (SELECT *, 0 AS side FROM rows WHERE ts < TIMESTAMP '2024-01-20 00:00:00'
 UNION ALL SELECT city, ts, event_id, value + 1000, 1 FROM rows WHERE ts >= TIMESTAMP '2024-01-15 00:00:00')
"""


def upsert_sides(spark, sf):
    """A store with the hours before 20 January and a batch with those from 15 January on.

    Both together hold every event; where they overlap the batch has other values.
    """
    rows = readings(spark, sf).select("city", tf.floor_hour(F.col("ts")).alias("ts"), "event_id",
                                      F.col("pm25").alias("value"))
    stored = rows.filter(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    batch = rows.filter(F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return stored, batch.withColumn("value", F.col("value") + 1000)


UPSERT_SQL = SIDES_SQL + """SELECT city, ts, event_id, round(value, 6) AS value FROM (SELECT *,
 row_number() OVER (PARTITION BY city, ts ORDER BY side, event_id) AS r FROM sides) WHERE r = 1"""


@query("upsert_first_wins", UPSERT_SQL)
def _(spark, sf):
    stored, batch = upsert_sides(spark, sf)
    merged = dedupe.upsert_first_wins(stored, batch, ["city", "ts"], [F.col("event_id")])
    return merged.withColumn("value", F.round("value", 6))


@query("upsert_new_rows", SIDES_SQL + """
SELECT city, ts, event_id, round(value, 6) AS value FROM (
 SELECT *, row_number() OVER (PARTITION BY city, ts ORDER BY event_id) AS r FROM sides WHERE side = 1) n
WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM sides o WHERE o.side = 0 AND o.city = n.city AND o.ts = n.ts)""")
def _(spark, sf):
    stored, batch = upsert_sides(spark, sf)
    fresh = dedupe.new_rows_only(stored, batch, ["city", "ts"], [F.col("event_id")])
    return fresh.withColumn("value", F.round("value", 6))


REQUESTS_SQL = """texts AS (
 SELECT o_orderkey AS request, o_orderpriority AS city,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' OR o_totalprice > 50000 THEN
   CASE WHEN o_orderkey % 50 = 0 THEN strftime(o_orderdate, '%d.%m.%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END END AS from_text,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 DAY * (floor(o_totalprice/600)::INTEGER - 20) END AS stop, o_orderkey FROM orders),
more AS (SELECT *, CASE WHEN o_orderkey % 70 = 0 THEN strftime(stop, '%d.%m.%Y') ELSE strftime(stop, '%Y-%m-%d') END AS to_text FROM texts),
requests AS (SELECT *, try_strptime(from_text, '%Y-%m-%d')::TIMESTAMP AS date_from,
  CASE WHEN to_text IS NULL THEN TIMESTAMP '2001-09-01 00:00:00' ELSE try_strptime(to_text, '%Y-%m-%d')::TIMESTAMP END AS date_to FROM more),
validated AS (
 SELECT request, city, date_from, date_to, floor(epoch(date_to - date_from)/86400)::INTEGER AS days,
  CASE WHEN from_text IS NULL THEN 'date_from is required'
   WHEN date_from IS NULL THEN 'Invalid date_from format: ''' || from_text || '''. Expected: YYYY-MM-DD'
   WHEN date_to IS NULL THEN 'Invalid date_to format: ''' || to_text || '''. Expected: YYYY-MM-DD'
   WHEN date_from >= date_to THEN 'date_from must be before date_to'
   WHEN floor(epoch(date_to - date_from)/86400) > 730 THEN 'date range too large: ' || floor(epoch(date_to - date_from)/86400)::INTEGER || ' days (max 730)'
   WHEN city NOT IN (SELECT event_type FROM events UNION ALL SELECT o_orderpriority FROM orders WHERE o_orderpriority < '5') THEN 'unknown city: ' || city
  END AS reason FROM requests)"""


def _requests(spark, sf):
    """Backfill requests derived from the orders, dates as text.

    Some dates are missing or not in the right form, some ranges are invalid, some have
    no end, and one priority is no known city.
    """
    day = F.expr("make_dt_interval(cast(floor(o_totalprice / 600) as int) - 20)")

    def text(column, every):
        return F.when(F.col("o_orderkey") % every == 0, F.date_format(column, "dd.MM.yyyy")).otherwise(
            F.date_format(column, "yyyy-MM-dd"))

    orders = table(spark, sf, "orders")
    rows = orders.select(
        F.col("o_orderkey").alias("request"), F.col("o_orderpriority").alias("city"),
        F.when((F.col("o_orderpriority") != "4-NOT SPECIFIED") | (F.col("o_totalprice") > 50000),
               text(F.col("o_orderdate"), 50)).alias("date_from"),
        F.when(F.col("o_orderstatus") != "O", text(F.col("o_orderdate") + day, 70)).alias("date_to"))
    known = readings(spark, sf).select("city").union(orders.filter("o_orderpriority < '5'").select("o_orderpriority"))
    return backfill.validate_requests(rows, as_of=F.lit("2001-09-01 00:00:00").cast("timestamp_ntz"), known=known)


@query("backfill_validation", "WITH " + REQUESTS_SQL + " SELECT *, reason IS NULL AS valid FROM validated")
def _(spark, sf):
    return _requests(spark, sf)


@query("backfill_chunks", "WITH " + REQUESTS_SQL + """
SELECT request, city, c::TIMESTAMP AS chunk_from, least(c + INTERVAL 30 DAY, date_to)::TIMESTAMP AS chunk_to FROM (
 SELECT *, unnest(generate_series(date_from, date_to, INTERVAL 30 DAY)) AS c FROM validated WHERE reason IS NULL) WHERE c < date_to""")
def _(spark, sf):
    chunks = backfill.chunk_requests(_requests(spark, sf).filter("valid"))
    return chunks.select("request", "city", "chunk_from", "chunk_to")


@query("backfill_coverage", """
WITH days AS (SELECT event_type AS city, datediff('day', date_trunc('day', min(ts)), date_trunc('day', max(ts)))::INTEGER AS days FROM events GROUP BY 1),
n AS (SELECT event_type AS city, count(DISTINCT date_trunc('hour', ts))::BIGINT AS "rows" FROM events GROUP BY 1)
SELECT city, days, coalesce("rows", 0) AS "rows", (days*24)::INTEGER AS expected_hours,
 CASE WHEN days > 0 THEN round(coalesce("rows", 0)*100.0::DOUBLE/(days*24), 9) END AS coverage_pct FROM days LEFT JOIN n USING (city)""")
def _(spark, sf):
    rows = readings(spark, sf)
    days = rows.groupBy("city").agg(F.date_diff(F.max("ts"), F.min("ts")).alias("days"))
    hours = rows.select("city", tf.floor_hour(F.col("ts")).alias("ts")).distinct()
    out = backfill.backfill_coverage(days, hours.groupBy("city").agg(F.count("ts").alias("rows")), KEYS)
    return out.withColumn("coverage_pct", F.round("coverage_pct", 9))


@query("ingest_summary", with_ctes(HOURLY_CTE, WEATHER_CTE) + """
SELECT city, coalesce(r.n, 0) AS readings, coalesce(w.n, 0) AS weather, l.aqi AS live_index
FROM (SELECT DISTINCT event_type AS city FROM events UNION SELECT DISTINCT o_orderpriority FROM orders) c
LEFT JOIN (SELECT city, count(*)::BIGINT AS n FROM hourly GROUP BY 1) r USING (city)
LEFT JOIN (SELECT city, count(*)::BIGINT AS n FROM weather GROUP BY 1) w USING (city)
LEFT JOIN (SELECT city, arg_max(aqi, ts) AS aqi FROM hourly GROUP BY 1) l USING (city)""")
def _(spark, sf):
    """Order priorities are series that no feed has anything of."""
    hours = hourly(spark, sf)
    others = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("city")).distinct()
    count = F.count(F.lit(1)).alias("value")
    parts = {
        "readings": hours.groupBy("city").agg(count),
        "weather": weather_plan(spark, sf).groupBy("city").agg(count),
        "live_index": hours.groupBy("city").agg(F.max_by("aqi", "ts").alias("value")),
    }
    return backfill.run_summary(hours.select("city").union(others).distinct(), parts, KEYS,
                                {"readings": 0, "weather": 0})


@query("dataset_profile", """
SELECT event_type AS city, count(*)::BIGINT AS "rows", min(ts) AS first_ts, max(ts) AS last_ts,
 round(avg(value), 9) AS mean_value, max(value) AS max_value FROM events GROUP BY 1""")
def _(spark, sf):
    out = backfill.dataset_profile(readings(spark, sf), KEYS, "ts", "pm25")
    return out.withColumn("mean_value", F.round("mean_value", 9))


@query("distinct_keys", """
SELECT event_type AS city, count(DISTINCT user_id)::BIGINT AS stations FROM events GROUP BY 1""")
def _(spark, sf):
    return readings(spark, sf).select("city", "station").distinct().groupBy("city").agg(
        F.count("station").alias("stations"))


@query("provenance_union", f"""
WITH u AS (
 SELECT event_id, event_type AS city, value AS pm25, 0::BIGINT AS location_id, 0 AS side FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'
 UNION ALL SELECT event_id, event_type, {index_sql('value')}::DOUBLE, -1::BIGINT, 1 FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00')
SELECT event_id, city, pm25, pm25 AS pm25_min, pm25 AS pm25_max, 0.0::DOUBLE AS pm25_sd, 100.0::DOUBLE AS coverage_pct,
 location_id, CASE side WHEN 1 THEN 'live' END AS source FROM u""")
def _(spark, sf):
    rows = readings(spark, sf).select("event_id", "city", "ts", F.col("pm25").alias("value"))
    early = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    history = quality.provenance(rows.filter(early), "value", "history").drop("value", "ts")
    live = quality.provenance(rows.filter(~early).withColumn("aqi", pm25_to_aqi(F.col("value"))), "aqi", "live")
    return history.unionByName(live.withColumn("source", F.lit("live")).drop("value", "aqi", "ts"),
                               allowMissingColumns=True)


@query("key_strings", """
SELECT c_custkey, replace(lower(c_name || ' ' || c_mktsegment), ' ', '_') AS city_key, lower(trim('  ' || c_mktsegment)) AS trimmed
FROM customer""")
def _(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", tf.city_key(F.concat_ws(" ", "c_name", "c_mktsegment")).alias("city_key"),
        F.lower(F.trim(F.concat(F.lit("  "), "c_mktsegment"))).alias("trimmed"))
