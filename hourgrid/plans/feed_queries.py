"""Queries that land payloads made from the tables and parse them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.functions import timefns as tf
from hourgrid.operators import stations
from hourgrid.plans.bindings import (
    AS_OF, HOURLY_CTE, KEYS, hourly_plan, index_sql, table, with_ctes)
from hourgrid.plans.catalog import query
from hourgrid.session import fresh_path
from hourgrid.sources import feeds, quarantine


def _landed(rows, columns, payload):
    """Text of JSON documents as they would lie in a landing folder."""
    return rows.select(*columns, F.to_json(payload).alias("payload"))


@query("json_measurements", with_ctes("usable AS (SELECT event_type AS city, date_trunc('hour', ts)::TIMESTAMP AS ts, value AS pm25, (props->>'$.k')::DOUBLE AS cov FROM events"
 " WHERE (props->>'$.k')::DOUBLE >= 50 AND NOT (event_type = 'error' AND value > 60) AND value BETWEEN 0 AND 999)") + f""",
h AS (SELECT city, ts, sum(round(pm25*100)::BIGINT)::DOUBLE/(count(pm25)*100)::DOUBLE AS pm25,
 min(pm25)::DOUBLE AS pm25_min, max(pm25 + 1)::DOUBLE AS pm25_max, avg(cov) AS coverage_pct FROM usable GROUP BY ALL)
SELECT city, ts, round(pm25, 9) AS pm25, pm25_min, round(pm25_max, 9) AS pm25_max, round(coverage_pct, 9) AS coverage_pct, {index_sql('pm25')} AS aqi FROM h""")
def _(spark, sf):
    record = F.struct(
        F.col("pm25").alias("value"),
        F.struct(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc")).alias("datetimeTo")).alias("period"),
        F.struct(F.get_json_object("props", "$.k").cast("double").alias("percentCoverage")).alias("coverage"),
        F.struct(((F.col("city") == "error") & (F.col("pm25") > 60)).alias("hasFlags")).alias("flagInfo"),
        F.struct(F.col("pm25").alias("min"), (F.col("pm25") + 1).alias("max")).alias("summary"))
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("city"), "ts", F.col("value").alias("pm25"), "props")
    pages = _landed(rows, ["city"], F.struct(F.array(record).alias("results")))
    out = feeds.measurements_hourly(pages, KEYS, "payload", decimals=2)
    return out.select("city", "ts", F.round("pm25", 9).alias("pm25"), "pm25_min",
                      F.round("pm25_max", 9).alias("pm25_max"),
                      F.round("coverage_pct", 9).alias("coverage_pct"), "aqi")


@query("json_arrays_roundtrip", with_ctes(HOURLY_CTE) + """
SELECT city, (ts - INTERVAL 330 MINUTE)::TIMESTAMP AS ts, aqi::DOUBLE AS temperature_2m, round(pm25, 9) AS wind_speed_10m,
 NULL::DOUBLE AS surface_pressure FROM hourly WHERE aqi <= 150""")
def _(spark, sf):
    hours = hourly_plan(spark, sf).withColumn("day", F.to_date("ts"))
    one = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
                   F.when(F.col("aqi") <= 150, F.col("aqi").cast("double")).alias("t"),
                   F.col("pm25").alias("w"))
    days = hours.groupBy("city", "day").agg(F.sort_array(F.collect_list(one)).alias("h"))  # 24 at most
    body = F.struct(F.struct(F.col("h.time").alias("time"),
                             F.transform("h", lambda x: x["t"]).alias("temperature_2m"),
                             F.col("h.w").alias("wind_speed_10m")).alias("hourly"))
    pages = days.select("city", F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))
    return feeds.weather_arrays(pages, KEYS, "payload").select(
        "city", "ts", "temperature_2m", F.round("wind_speed_10m", 9).alias("wind_speed_10m"), "surface_pressure")


@query("live_json", f"""
SELECT event_id, event_type AS city,
 CASE WHEN (props->>'$.k')::BIGINT >= 90 THEN TIMESTAMP '{AS_OF}' WHEN user_id < 50 THEN date_trunc('second', ts)::TIMESTAMP - INTERVAL 330 MINUTE
  ELSE date_trunc('second', ts)::TIMESTAMP END AS ts,
 aqi, value AS temperature, NULL::DOUBLE AS humidity, aqi::DOUBLE AS pm25, -1::BIGINT AS location_id, 'live' AS source
FROM (SELECT *, {index_sql('value')} AS aqi FROM events) WHERE event_type <> 'error' AND value <= 150""")
def _(spark, sf):
    from hourgrid.functions.index import pm25_to_aqi

    rows = table(spark, sf, "events").select("event_id", F.col("event_type").alias("city"), "ts", "value", "user_id", "props")
    k = F.get_json_object("props", "$.k").cast("bigint")
    body = F.struct(
        F.when(F.col("city") == "error", "error").otherwise("ok").alias("status"),
        F.struct(F.when(F.col("value") <= 150, pm25_to_aqi(F.col("value"))).alias("aqi"),
                 F.struct(F.when(k >= 90, "garbled").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("s"),
                          F.when(F.col("user_id") >= 50, "+00:00").alias("tz")).alias("time"),
                 F.struct(F.struct(F.col("value").alias("v")).alias("t")).alias("iaqi")).alias("data"))
    out = feeds.live_readings(_landed(rows, ["event_id", "city"], body), ["event_id", "city"], "payload",
                              F.lit(AS_OF))
    return out.select("event_id", "city", "ts", "aqi", "temperature", "humidity", "pm25", "location_id", "source")


@query("sensor_json", """
SELECT l_suppkey AS location, max(l_partkey) AS sensor, count(*)::BIGINT AS candidates FROM lineitem
WHERE l_returnflag = 'A' GROUP BY 1""")
def _(spark, sf):
    items = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_returnflag")
    listed = F.array(F.struct(F.col("l_partkey").alias("id"), F.struct(
        F.when(F.col("l_returnflag") == "A", "PM25").otherwise("no2").alias("name")).alias("parameter")))
    pages = items.select(F.col("l_suppkey").alias("location"),
                         F.to_json(F.struct(listed.alias("results"))).alias("payload"))
    rows = stations.of_parameter(feeds.sensors(pages, ["location"], "payload"), "parameter")
    return stations.active_sensor(rows, "location", "sensor")


@query("local_time_labels", """
SELECT event_id, ts - INTERVAL 330 MINUTE AS utc, ts + INTERVAL 330 MINUTE AS local,
 strftime(ts + INTERVAL 330 MINUTE, '%d %b %H:%M') || ' IST' AS label,
 strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS iso,
 strftime(ts, '%Y-%m-%d') AS date_key, round_even(value, 0)::INTEGER AS whole FROM events""")
def _(spark, sf):
    from hourgrid.functions.index import whole_index

    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", tf.local_to_utc(ts).alias("utc"), tf.utc_to_local(ts).alias("local"),
        tf.local_label(ts).alias("label"), tf.local_iso(ts).alias("iso"),
        tf.date_key(ts).alias("date_key"), whole_index(F.col("value")).alias("whole"))


@query("quarantined_measurements", """
WITH e AS (SELECT event_type AS city, value, event_id, (props->>'$.k')::BIGINT AS k FROM events),
r AS (SELECT city, CASE WHEN event_id % 50 = 7 THEN 'unreadable payload' WHEN k < 3 THEN 'unreadable record' WHEN k < 20 THEN 'low coverage'
 WHEN k < 25 THEN 'flagged' WHEN k < 30 THEN 'no value' WHEN k < 35 THEN 'no time' WHEN k < 40 THEN 'out of bounds' ELSE 'usable' END AS reason, count(*) AS n FROM e GROUP BY ALL)
SELECT city, reason, n::BIGINT AS n FROM r UNION ALL SELECT 'landed', 'all', count(*)::BIGINT FROM events""")
def quarantined_measurements(spark, sf):
    """Measurement pages with records of every fault: each record is in the readings or in quarantine."""
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("city"), "ts", "value", "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    k, value = F.col("k"), F.col("value").cast("string")
    shown = F.when(k < 3, '"oops"').when((k >= 25) & (k < 30), "null").when((k >= 35) & (k < 40), "-5.0").otherwise(value)
    time = F.when((k >= 30) & (k < 35), "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    record = F.format_string('{"value": %s, "period": {"datetimeTo": {"utc": "%s"}}, "coverage": {"percentCoverage": %d}, "flagInfo": {"hasFlags": %s}}',
                             shown, time, F.when((k >= 3) & (k < 20), 20).otherwise(90), F.when((k >= 20) & (k < 25), "true").otherwise("false"))
    # a good record beside each bad one; a page cut off in the middle
    page = F.when(F.col("event_id") % 50 == 7, F.concat(F.lit('{"results": ['), F.left(record, F.lit(30)))).otherwise(
        F.concat(F.lit('{"results": ['), record, F.lit("]}")))
    judged = quarantine.judged_measurements(rows.select("city", page.alias("payload")), KEYS, "payload")
    usable, rejected = fresh_path(spark, "usable"), fresh_path(spark, "rejected")
    quarantine.apart(judged, usable, rejected)
    good = spark.read.parquet(usable).select("city", F.lit("usable").alias("reason"))
    both = good.unionByName(spark.read.parquet(rejected).select("city", "reason"))
    counts = both.groupBy("city", "reason").agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(counts.agg(F.sum("n").alias("n")).select(F.lit("landed").alias("city"), F.lit("all").alias("reason"), "n"))
