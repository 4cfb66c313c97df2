"""Queries that write a store or report and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.functions.timefns import city_key
from hourgrid.operators import backfill, baseline, drift, metrics, quality
from hourgrid.plans.bindings import (
    DAILY_CTE, HOURLY_CTE, KEYS, WEATHER_CTE, daily_orders, hourly, hourly_plan, index_sql, table,
    weather_plan, with_ctes)
from hourgrid.plans.catalog import ORACLES, query
from hourgrid.plans.drift_queries import AS_OF as DRIFT_AS_OF
from hourgrid.plans.drift_queries import DRIFT_NUMBERS, RECENT_SQL, SEASONAL, _drift_sql, _inputs, _raw
from hourgrid.plans.feature_queries import hourly_features
from hourgrid.plans.forecast_queries import NAIVE, REPORT_CTE, _naive
from hourgrid.plans.ingest_queries import UPSERT_SQL, upsert_sides
from hourgrid.session import fresh_path
from hourgrid.sources import baselines, history, quarantine, stores
from hourgrid.dimensions import WEATHER_COLS


CITY_CODES = {"click": "007", "view": "1e3", "error": "2024-01-01", "signup": "0x1F"}


@query("store_upsert", "SELECT CASE city " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CITY_CODES.items())
       + f" ELSE city END AS city, ts, event_id, value FROM ({UPSERT_SQL})")
def store_upsert(spark, sf):
    """Two overlapping batches merged into a day-partitioned store, one of them twice, read back.

    The cities have codes that look like numbers and dates; they stay text.
    """
    path = fresh_path(spark, "readings")
    stored, batch = (side.replace(CITY_CODES, subset=["city"]) for side in upsert_sides(spark, sf))
    for side in (stored, batch, batch):
        stores.upsert_days(spark, path, side, ["city"], "ts", [F.col("event_id")])
    rows = stores.read_store(spark, path)
    return rows.select("city", "ts", "event_id", F.round("value", 6).alias("value"))


@query("storage_verification", with_ctes(HOURLY_CTE, WEATHER_CTE) + """
SELECT city, 'readings' AS kind, count(DISTINCT ts::DATE)::BIGINT AS days, min(ts)::DATE AS first_date, max(ts)::DATE AS last_date FROM hourly GROUP BY city
UNION ALL SELECT city, 'weather', count(DISTINCT ts::DATE)::BIGINT, min(ts)::DATE, max(ts)::DATE FROM weather GROUP BY city""")
def _(spark, sf):
    paths = {}
    for kind, rows in (("readings", hourly_plan(spark, sf)), ("weather", weather_plan(spark, sf))):
        paths[kind] = fresh_path(spark, kind)
        (rows.withColumn("date", F.to_date("ts")).hint("rebalance", "city", "date")
         .write.partitionBy("city", "date").parquet(paths[kind]))
    return backfill.storage_verification({k: spark.read.parquet(p) for k, p in paths.items()}, KEYS)


@query("feature_store", with_ctes(HOURLY_CTE) + "SELECT city, ts, aqi::DOUBLE AS aqi, lower(city) AS city_key FROM hourly")
def _(spark, sf):
    path = fresh_path(spark, "features")
    rows = hourly_plan(spark, sf).select("ts", F.col("aqi").cast("double").alias("aqi"), "city",
                                    city_key(F.col("city")).alias("city_key"))
    stores.write_features(rows, path, ["city_key"])
    return spark.read.parquet(path)


@query("feature_table_store", ORACLES["hourly_features"])
def _(spark, sf):
    """The whole feature table through its store: every column, one folder a city, read back."""
    path = fresh_path(spark, "feature-table")
    stores.write_features(hourly_features(spark, sf), path, KEYS)
    return spark.read.parquet(path)


@query("absent_weather", with_ctes(HOURLY_CTE) + "SELECT city, ts, aqi, " + ", ".join(
    f"NULL::DOUBLE AS {c}" for c in WEATHER_COLS) + " FROM hourly")
def _(spark, sf):
    rows = hourly_plan(spark, sf).select("city", "ts", "aqi")
    wx = stores.read_weather_or_null(spark, fresh_path(spark, "no-weather"), rows, ["city", "ts"])
    return rows.join(wx, ["city", "ts"], "left")


@query("baseline_store", with_ctes(DAILY_CTE) + """
SELECT city, ds, round(y, 9) AS aqi, month(ds)::INTEGER AS month FROM daily QUALIFY count(*) OVER (PARTITION BY city, month(ds)) >= 100""")
def _(spark, sf):
    path = fresh_path(spark, "baseline")
    rows = baseline.monthly_baseline(daily_orders(spark, sf), KEYS)
    rows.hint("rebalance", "city", "month").write.partitionBy("city", "month").parquet(path)
    back = spark.read.schema(rows.schema).parquet(path)  # there may be no month with enough rows
    return back.select("city", "ds", F.round("aqi", 9).alias("aqi"), "month")


#: Two series keep every third day only, too few a month for baselines of their own.
THIN_CTE = "thin AS (SELECT * FROM daily WHERE city NOT LIKE '1%' AND city NOT LIKE '5%' OR day(ds) % 3 = 0)"


def _thin_baselines(spark, sf):
    rows = daily_orders(spark, sf).filter(~F.col("city").rlike("^[15]") | (F.day("ds") % 3 == 0))
    path = fresh_path(spark, "baselines")
    baselines.write_baselines(rows, path, KEYS)
    return path


@query("baseline_annual_store", with_ctes(DAILY_CTE, THIN_CTE) + "SELECT city, ds, round(y, 9) AS aqi, month(ds)::INTEGER AS month FROM thin")
def baseline_annual_store(spark, sf):
    """The baselines of all months, read back from their store."""
    return baselines.read_baselines(spark, _thin_baselines(spark, sf), KEYS).withColumn("aqi", F.round("aqi", 9))


@query("baseline_seasonal_store", with_ctes(DAILY_CTE, THIN_CTE) + """
SELECT city, ds, round(y, 9) AS aqi, month(ds)::INTEGER AS month FROM thin
QUALIFY count(*) FILTER (WHERE month(ds) = 4) OVER (PARTITION BY city) < 100 OR month(ds) = 4""")
def baseline_seasonal_store(spark, sf):
    """April's baselines from the store, of all months for the series that have too few rows in April."""
    return baselines.read_baselines(spark, _thin_baselines(spark, sf), KEYS, 4).withColumn("aqi", F.round("aqi", 9))


@query("stored_baseline_drift", with_ctes(HOURLY_CTE, RECENT_SQL) + "," + _drift_sql(SEASONAL, "seasonal"))
def stored_baseline_drift(spark, sf):
    """A seasonal drift check against stored baselines, without the features."""
    features, series = _inputs(spark, sf)
    path = fresh_path(spark, "baselines")
    baselines.write_baselines(features, path, KEYS)
    moment = F.lit(DRIFT_AS_OF).cast("timestamp_ntz")
    recent = drift.recent_hourly(_raw(spark, sf), KEYS, "ts", "aqi", moment)
    stored = baselines.read_baselines(spark, path, KEYS, int(DRIFT_AS_OF[5:7]))
    out = drift.check_drift(stored, recent, series, KEYS, "seasonal", moment)
    return out.withColumns({n: F.round(n, 9) for n in DRIFT_NUMBERS})


@query("stats_json", with_ctes(HOURLY_CTE) + """
SELECT city, count(aqi)::BIGINT AS n_samples, round(avg(aqi), 9) AS aqi_mean, round(quantile_cont(aqi::DOUBLE, 0.5), 9) AS aqi_median,
 max(aqi)::DOUBLE AS aqi_max FROM hourly GROUP BY city""")
def _(spark, sf):
    path = fresh_path(spark, "stats")
    rows = hourly(spark, sf).select("city", F.col("aqi").cast("double").alias("y"))
    stats = baseline.baseline_stats(rows, KEYS)
    stores.write_json(stats, path)
    back = spark.read.schema(stats.schema).json(path)
    return back.select("city", "n_samples", F.round("aqi_mean", 9).alias("aqi_mean"),
                       F.round("aqi_median", 9).alias("aqi_median"), "aqi_max")


@query("drift_snapshot", with_ctes(HOURLY_CTE, RECENT_SQL) + f"""
SELECT city, ts, round(aqi, 9) AS aqi, TIMESTAMP '{DRIFT_AS_OF}' AS checked_at FROM recent""")
def _(spark, sf):
    path = fresh_path(spark, "recent")
    moment = F.lit(DRIFT_AS_OF).cast("timestamp_ntz")
    stores.write_snapshot(drift.recent_hourly(_raw(spark, sf), KEYS, "ts", "aqi", moment), path, DRIFT_AS_OF)
    return spark.read.parquet(path).withColumn("aqi", F.round("aqi", 9))


@query("report_files", NAIVE + ", " + REPORT_CTE + """
SELECT city, test_rows, round(mae, 9) AS mae, round(coverage_95, 9) AS coverage_95, 5 AS bins, '2024-01-31 00:00:00' AS generated_at FROM report0""")
def _(spark, sf):
    """The nested evaluation report as JSON and CSV; the CSV is read back."""
    folder = fresh_path(spark, "reports")
    scored = _naive(spark, sf).filter("split = 'test'")
    stores.write_report(metrics.evaluation_report(scored, KEYS), folder, "2024-01-31 00:00:00")
    back = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/evaluation_latest.csv")
    bins = F.json_array_length("calibration_bins")
    return back.select("city", F.col("test_rows").cast("bigint").alias("test_rows"),
                       F.round(F.col("mae").cast("double"), 9).alias("mae"),
                       F.round(F.col("coverage_95").cast("double"), 9).alias("coverage_95"),
                       bins.alias("bins"), "generated_at")


HISTORY_SQL = f"""rows0 AS (SELECT CASE event_type WHEN 'error' THEN ' Calcutta' WHEN 'click' THEN 'NEW DELHI ' WHEN 'view' THEN 'mumbai' WHEN 'signup' THEN 'Bangalore' ELSE 'Atlantis' END AS raw,
  CASE WHEN value > 300 THEN NULL ELSE date_trunc('hour', ts)::TIMESTAMP END AS ts, value,
  CASE WHEN (props->>'$.k')::BIGINT < 5 THEN NULL WHEN (props->>'$.k')::BIGINT > 95 THEN 5000 ELSE value END AS pm25,
  CASE WHEN event_id % 2 = 0 THEN value END AS temp, lpad(event_id::VARCHAR, 12, '0') AS seq FROM events),
named AS (SELECT CASE raw WHEN ' Calcutta' THEN 'Kolkata' WHEN 'NEW DELHI ' THEN 'Delhi' WHEN 'mumbai' THEN 'Mumbai' WHEN 'Bangalore' THEN 'Bengaluru' END AS city, ts, pm25, value, temp, seq
 FROM rows0 WHERE raw <> 'Atlantis' AND ts IS NOT NULL)"""


def _landed_csv(spark, sf):
    """The events as a history file: odd spellings, unreadable dates and numbers, values out of bounds."""
    path = fresh_path(spark, "history")
    kind, value = F.col("event_type"), F.col("value")
    k = F.get_json_object("props", "$.k").cast("bigint")
    city = (F.when(kind == "error", " Calcutta").when(kind == "click", "NEW DELHI ").when(kind == "view", "mumbai")
            .when(kind == "signup", "Bangalore").otherwise("Atlantis"))
    rows = table(spark, sf, "events").select(
        F.when(value > 300, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("Datetime"),
        city.alias("City"),
        F.when(k < 5, "n/a").when(k > 95, "5000").otherwise(value.cast("string")).alias("PM2_5_ugm3"),
        F.when(F.col("event_id") % 2 == 0, value.cast("string")).otherwise("?").alias("Temp_2m_C"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("Seq"), (value * 3).cast("string").alias("Wind_Speed_10m_kmh"),
        F.lit("180").alias("Wind_Dir_10m"), F.lit("").alias("Humidity_Percent"),
        F.lit("0").alias("Precipitation_mm"), F.lit("bad").alias("Pressure_MSL_hPa"),
        F.lit("Winter").alias("Season"))
    # quoted blanks must survive the round trip: the spellings are part of the case
    (rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


@query("history_readings", "WITH " + HISTORY_SQL + f""", good AS (SELECT city, ts, arg_min(pm25, seq) AS pm25 FROM named WHERE pm25 BETWEEN 0 AND 999 GROUP BY ALL)
SELECT city, ts AS timestamp, pm25, 0.0::DOUBLE AS pm25_sd, 100.0::DOUBLE AS coverage_pct, {index_sql('pm25')} AS aqi, 0::BIGINT AS location_id FROM good""")
def _(spark, sf):
    return history.readings(history.read_history(spark, _landed_csv(spark, sf)), ["Seq"]).drop("pm25_min", "pm25_max")


@query("history_weather", "WITH " + HISTORY_SQL + """, one AS (
SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY city, ts ORDER BY temp IS NULL, seq) = 1)
SELECT city, ts AS timestamp, temp AS temperature_2m, round(value*3/3.6::DOUBLE, 6) AS wind_speed_10m, 180.0::DOUBLE AS wind_direction_10m,
 NULL::DOUBLE AS relative_humidity_2m, 0.0::DOUBLE AS precipitation, NULL::DOUBLE AS surface_pressure, 'Winter' AS season FROM one""")
def _(spark, sf):
    """Every second temperature does not parse: the first row of an hour that has one wins."""
    return history.weather(history.read_history(spark, _landed_csv(spark, sf)), ["Seq"]).withColumn("wind_speed_10m", F.round("wind_speed_10m", 6))


@query("quarantined_history", """
WITH r AS (SELECT CASE WHEN event_type NOT IN ('error', 'click', 'view', 'signup') THEN 'unknown city' WHEN value > 300 THEN 'no time'
 WHEN (props->>'$.k')::BIGINT < 5 THEN 'no value' WHEN (props->>'$.k')::BIGINT > 95 THEN 'out of bounds' WHEN value NOT BETWEEN 0 AND 999 THEN 'out of bounds'
 ELSE 'usable' END AS reason FROM events)
SELECT reason, count(*)::BIGINT AS n FROM r GROUP BY 1 UNION ALL SELECT 'unreadable line', 2::BIGINT UNION ALL SELECT 'all', count(*)::BIGINT + 2 FROM events""")
def quarantined_history(spark, sf):
    """A history file with odd lines, and two with too few or too many fields: all of them are accounted for."""
    path = _landed_csv(spark, sf)
    header = ",".join(spark.read.csv(path, header=True).columns)
    broken = [header, "2024-01-01 00:00:00,Delhi", "2024-01-01 00:00:00,Delhi,1,2,3,4,5,6,7,8,9,10,11,12"]
    spark.createDataFrame([("\n".join(broken),)], "line string").coalesce(1).write.mode("append").text(path)
    usable, rejected = fresh_path(spark, "usable"), fresh_path(spark, "rejected")
    quarantine.apart(quarantine.judged_history(quarantine.read_lines(spark, path)), usable, rejected)
    good = spark.read.parquet(usable).select(F.lit("usable").alias("reason"))
    counts = good.unionByName(spark.read.parquet(rejected).select("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(counts.agg(F.sum("n").alias("n")).select(F.lit("all").alias("reason"), "n"))


@query("stations_in_order", """
SELECT user_id AS station, count(*)::BIGINT AS readings, row_number() OVER (ORDER BY user_id) AS position FROM events GROUP BY user_id""")
def stations_in_order(spark, sf):
    """Stations written in the order of their ids, and found in that order in the files."""
    path = fresh_path(spark, "stations")
    stations = table(spark, sf, "events").groupBy(F.col("user_id").alias("station")).agg(F.count(F.lit(1)).alias("readings"))
    stores.write_ordered(stations, path, ["station"], files=5)
    return stores.read_positions(spark, path)


@query("weather_columns_present", with_ctes(WEATHER_CTE) + "SELECT city, ts, temperature_2m, wind_speed_10m, strftime(ts, '%H') AS temp_inversion FROM weather")
def weather_columns_present(spark, sf):
    """Of all weather columns those that a stored table has, among them an optional one; others are not made up."""
    path = fresh_path(spark, "weather")
    rows = weather_plan(spark, sf).withColumns({"temp_inversion": F.date_format("ts", "HH"), "station_note": F.lit("n/a")})
    rows.write.parquet(path)
    return quality.keep_present(spark.read.parquet(path), ["city", "ts", *WEATHER_COLS, "temp_inversion"])
