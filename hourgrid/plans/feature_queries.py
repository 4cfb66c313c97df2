"""Queries on grids, windows, calendar features and the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.dimensions import LAG_HOURS, ROLLING_WINDOWS
from hourgrid.functions import index as ix
from hourgrid.functions import timefns as tf
from hourgrid.operators.features import feature_table, with_series_windows
from hourgrid.operators.grid import directional_fill, grid_gaps, hourly_grid
from hourgrid.operators.quality import (
    column_coverage, fill_with_series_mean, wind_unit_fix, with_missing_as_null)
from hourgrid.plans.bindings import (
    DAILY_CTE, GRID_CTE, HOURLY_CTE, KEYS, WEATHER_CTE, daily_plan, hourly, hourly_plan, index_sql,
    label_sql, readings, table, weather, weather_plan, with_ctes)
from hourgrid.plans.catalog import query
from hourgrid.session import saved

LAG_CTE = "filled AS (SELECT *, avg(aqi) OVER (PARTITION BY city) AS m,\n" + ",\n".join(
    f" lag(aqi, {h}) OVER w AS l{h}" for h in LAG_HOURS) + "\n FROM grid WINDOW w AS (PARTITION BY city ORDER BY ts))"


def _lag_sql(h: int) -> str:
    return (f"coalesce(first_value(l{h} IGNORE NULLS) OVER (PARTITION BY city ORDER BY ts"
            f" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), m)::DOUBLE AS aqi_lag_{h}h")


def _rolling_sql(h: int, name: str, first: int, last: str) -> str:
    over = (f"OVER (PARTITION BY city ORDER BY ts ROWS BETWEEN {first} PRECEDING AND {last})")
    return (f"round(coalesce(avg(aqi) {over}, m), 9) AS aqi_roll_mean_{name},"
            f" round(coalesce(stddev_samp(aqi) {over}, m), 9) AS aqi_roll_std_{name},"
            f" round(coalesce(max(aqi) {over}, m)::DOUBLE, 9) AS aqi_roll_max_{name}")


def _rounded(df, names):
    return df.withColumns({n: F.round(n, 9) for n in names})


def _observed(spark, sf):
    return hourly(spark, sf).withColumn("aqi", F.col("aqi").cast("double"))


ROLL_STATS = [f"aqi_roll_{s}_{n}" for _, n in ROLLING_WINDOWS for s in ("mean", "std")]
LAG_NAMES = [f"aqi_lag_{h}h" for h in LAG_HOURS]


@query("hourly_grid", with_ctes(HOURLY_CTE, GRID_CTE) + "SELECT city, ts, round(pm25, 9) AS pm25, aqi FROM grid")
def _(spark, sf):
    return hourly_grid(hourly(spark, sf), KEYS).select("city", "ts", F.round("pm25", 9).alias("pm25"), "aqi")


@query("hourly_grid_gaps", with_ctes(HOURLY_CTE, GRID_CTE) + """
SELECT city, min(ts) AS grid_start, max(ts) AS grid_end, count(*)::BIGINT AS grid_hours,
 count(aqi)::BIGINT AS present_hours, (count(*) - count(aqi))::BIGINT AS missing_hours
FROM grid GROUP BY city""")
def _(spark, sf):
    return grid_gaps(hourly(spark, sf), KEYS, "ts", "aqi")


@query("grid_fill", with_ctes(HOURLY_CTE, GRID_CTE) + """
SELECT city, ts, aqi,
 last_value(aqi IGNORE NULLS) OVER (PARTITION BY city ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS forward,
 first_value(aqi IGNORE NULLS) OVER (PARTITION BY city ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS backward
FROM grid""")
def _(spark, sf):
    grid = hourly_grid(hourly(spark, sf), KEYS).select("city", "ts", "aqi")
    forward = directional_fill(grid, KEYS, "ts", "aqi", "forward", bucket_hours=168)
    return directional_fill(forward, KEYS, "ts", "aqi", "backward", backward=True, bucket_hours=168)


@query("lags_bfill", with_ctes(HOURLY_CTE, GRID_CTE, LAG_CTE)
       + f"SELECT * FROM (SELECT city, ts, aqi::DOUBLE AS aqi, {', '.join(_lag_sql(h) for h in LAG_HOURS)} FROM filled) WHERE aqi IS NOT NULL")
def _(spark, sf):
    return with_series_windows(_observed(spark, sf).drop("pm25"), KEYS, "ts", "aqi", windows=())


@query("rolling_inclusive", with_ctes(HOURLY_CTE, GRID_CTE, LAG_CTE) + "SELECT * FROM (SELECT city, ts, aqi::DOUBLE AS aqi, "
       + ", ".join(_rolling_sql(h, n, h - 1, "CURRENT ROW") for h, n in ROLLING_WINDOWS)
       + " FROM filled) WHERE aqi IS NOT NULL")
def _(spark, sf):
    out = with_series_windows(_observed(spark, sf).drop("pm25"), KEYS, "ts", "aqi", lags=())
    return _rounded(out, ROLL_STATS)


@query("rolling_exclusive", with_ctes(HOURLY_CTE, GRID_CTE, LAG_CTE) + "SELECT * FROM (SELECT city, ts, aqi::DOUBLE AS aqi, "
       + ", ".join(_rolling_sql(h, n, h, "1 PRECEDING") for h, n in ROLLING_WINDOWS)
       + " FROM filled) WHERE aqi IS NOT NULL")
def _(spark, sf):
    out = with_series_windows(_observed(spark, sf).drop("pm25"), KEYS, "ts", "aqi", lags=(),
                              include_current=False)
    return _rounded(out, [*ROLL_STATS, *[f"aqi_roll_max_{n}" for _, n in ROLLING_WINDOWS]])


CALENDAR_SQL = """hour({t})::INTEGER AS hour, (isodow({t})-1)::INTEGER AS dayofweek, month({t})::INTEGER AS month,
 (isodow({t})>=6)::INTEGER AS is_weekend,
 (hour({t}) BETWEEN 7 AND 10 OR hour({t}) BETWEEN 17 AND 20)::INTEGER AS is_rush_hour,
 round(sin(hour({t})*2*pi()/24), 9) AS hour_sin, round(cos(hour({t})*2*pi()/24), 9) AS hour_cos,
 round(sin((isodow({t})-1)*2*pi()/7), 9) AS dow_sin, round(cos((isodow({t})-1)*2*pi()/7), 9) AS dow_cos,
 round(sin(month({t})*2*pi()/12), 9) AS month_sin, round(cos(month({t})*2*pi()/12), 9) AS month_cos"""
SEASON_SQL = """(month({t}) IN (10, 11))::INTEGER::DOUBLE AS crop_burning,
 (CASE month({t}) WHEN 10 THEN 0.55 WHEN 11 THEN 0.50 ELSE 0 END)::DOUBLE AS festival_period"""
CYCLIC = [f"{p}_{f}" for p in ("hour", "dow", "month") for f in ("sin", "cos")]


@query("calendar_cyclic", f"SELECT event_id, {CALENDAR_SQL.format(t='ts')} FROM events")
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts")
    return _rounded(tf.with_cyclic(tf.with_calendar(rows, "ts")), CYCLIC).drop("ts")


@query("bonus_features", f"SELECT o_orderkey, {SEASON_SQL.format(t='o_orderdate')} FROM orders")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return tf.with_season_effects(rows, "o_orderdate").drop("o_orderdate")


WEATHER_ON_GRID_CTE = """wmean AS (
 SELECT city, avg(CASE WHEN mw > 15 THEN wind_speed_10m/3.6::DOUBLE ELSE wind_speed_10m END) AS wm, avg(temperature_2m) AS tm
 FROM grid JOIN weather USING (city, ts)
 JOIN (SELECT city, avg(wind_speed_10m) AS mw FROM weather GROUP BY city) USING (city) GROUP BY city),
fixed AS (
 SELECT city, ts, temperature_2m, CASE WHEN mw > 15 THEN wind_speed_10m/3.6::DOUBLE ELSE wind_speed_10m END AS wind_speed_10m
 FROM weather JOIN (SELECT city, avg(wind_speed_10m) AS mw FROM weather GROUP BY city) USING (city))"""


@query("hourly_features", with_ctes(HOURLY_CTE, GRID_CTE, WEATHER_CTE, WEATHER_ON_GRID_CTE, LAG_CTE)
       + "SELECT * EXCLUDE (m, tm, wm, temperature_2m0, wind_speed_10m0), round(coalesce(temperature_2m0, tm), 9) AS temperature_2m,"
       + " round(coalesce(wind_speed_10m0, wm), 9) AS wind_speed_10m FROM (SELECT city, ts AS ds,"
       + " round(pm25, 9) AS pm25, aqi::DOUBLE AS y, m, "
       + ", ".join(_lag_sql(h) for h in LAG_HOURS) + ", "
       + ", ".join(_rolling_sql(h, n, h - 1, "CURRENT ROW") for h, n in ROLLING_WINDOWS) + ", "
       + CALENDAR_SQL.format(t="ts") + ", " + SEASON_SQL.format(t="ts")
       + ", f.temperature_2m AS temperature_2m0, f.wind_speed_10m AS wind_speed_10m0 FROM filled LEFT JOIN fixed f USING (city, ts))"
       + " JOIN wmean USING (city) WHERE y IS NOT NULL")
def hourly_features(spark, sf):
    wx = wind_unit_fix(weather(spark, sf), KEYS)
    out = feature_table(hourly(spark, sf), KEYS, weather=wx)
    return _rounded(out, ["pm25", *ROLL_STATS, *CYCLIC, "temperature_2m", "wind_speed_10m"])


@query("readings_weather_join", with_ctes(HOURLY_CTE, WEATHER_CTE) + """
SELECT h.city, h.ts, h.aqi, round(w.temperature_2m, 9) AS temperature_2m, w.wind_speed_10m
FROM hourly h LEFT JOIN weather w USING (city, ts)""")
def _(spark, sf):
    joined = hourly_plan(spark, sf).join(weather_plan(spark, sf), ["city", "ts"], "left")
    return joined.select("city", "ts", "aqi", F.round("temperature_2m", 9).alias("temperature_2m"),
                         "wind_speed_10m")


@query("wind_unit_fix", with_ctes(WEATHER_CTE) + """
SELECT w.city, w.ts, round(CASE WHEN mw > 15 THEN wind_speed_10m/3.6::DOUBLE ELSE wind_speed_10m END, 9) AS wind_speed_10m
FROM weather w JOIN (SELECT city, avg(wind_speed_10m) AS mw FROM weather GROUP BY city) USING (city)""")
def _(spark, sf):
    return _rounded(wind_unit_fix(weather(spark, sf).drop("temperature_2m"), KEYS), ["wind_speed_10m"])


@query("impute_mean", with_ctes(HOURLY_CTE, GRID_CTE, WEATHER_CTE) + """
SELECT city, ts, round(coalesce(temperature_2m, avg(temperature_2m) OVER (PARTITION BY city)), 9) AS temperature_2m
FROM grid LEFT JOIN weather USING (city, ts)""")
def _(spark, sf):
    grid = hourly_grid(hourly(spark, sf), KEYS).select("city", "ts")
    joined = saved(grid.join(weather_plan(spark, sf).drop("wind_speed_10m"), ["city", "ts"], "left"), "joined")
    return _rounded(fill_with_series_mean(joined, KEYS, ["temperature_2m"]), ["temperature_2m"])


@query("index_category", f"""
SELECT event_id, aqi, {label_sql('aqi')} AS label,
 CASE {label_sql('aqi')} WHEN 'Good' THEN '#00b050' WHEN 'Satisfactory' THEN '#92d050' WHEN 'Moderate' THEN '#ffff00'
  WHEN 'Poor' THEN '#ff9900' WHEN 'Very Poor' THEN '#ff0000' ELSE '#c00000' END AS color,
 CASE WHEN value <= 50 THEN '#00b050' WHEN value <= 100 THEN '#92d050' WHEN value <= 200 THEN '#ffff00'
  WHEN value <= 300 THEN '#ff9900' WHEN value <= 400 THEN '#ff0000' ELSE '#c00000' END AS display_color
FROM (SELECT event_id, value, {index_sql('value')} AS aqi FROM events)""")
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "value", ix.pm25_to_aqi(F.col("value")).alias("aqi"))
    category = ix.aqi_category(F.col("aqi"))
    return rows.select("event_id", "aqi", category["label"].alias("label"), category["color"].alias("color"),
                       ix.display_color(F.col("value")).alias("display_color"))


@query("column_coverage", with_ctes(HOURLY_CTE, GRID_CTE, WEATHER_CTE) + """
, joined AS (SELECT * FROM grid LEFT JOIN weather USING (city, ts))
SELECT city, count(*)::BIGINT AS "rows", 'aqi' AS "column", count(aqi)::BIGINT AS n, round(count(aqi)*100.0::DOUBLE/count(*), 9) AS coverage_pct FROM joined GROUP BY city
UNION ALL SELECT city, count(*)::BIGINT, 'temperature_2m', count(temperature_2m)::BIGINT, round(count(temperature_2m)*100.0::DOUBLE/count(*), 9) FROM joined GROUP BY city
UNION ALL SELECT city, count(*)::BIGINT, 'surface_pressure', 0::BIGINT, 0.0::DOUBLE FROM joined GROUP BY city""")
def _(spark, sf):
    joined = hourly_grid(hourly(spark, sf), KEYS).join(weather_plan(spark, sf), ["city", "ts"], "left")
    joined = with_missing_as_null(joined, ["surface_pressure"])
    return _rounded(column_coverage(joined, KEYS, ["aqi", "temperature_2m", "surface_pressure"]),
                    ["coverage_pct"])


@query("station_series_features", """
WITH hourly0 AS (
 SELECT user_id AS station, event_type AS city, date_trunc('hour', ts)::TIMESTAMP AS ts,
  sum(round(value*100)::BIGINT)::DOUBLE / (count(value)*100)::DOUBLE AS pm25 FROM events GROUP BY ALL),
hourly AS (SELECT station, city, ts, """ + index_sql("pm25") + """ AS aqi FROM hourly0),
bounds AS (SELECT station, city, date_trunc('day', min(ts))::TIMESTAMP AS g0,
  (CASE WHEN max(ts) = date_trunc('day', max(ts)) THEN max(ts) ELSE date_trunc('day', max(ts)) + INTERVAL 1 DAY END - INTERVAL 1 HOUR)::TIMESTAMP AS g1
 FROM hourly GROUP BY ALL),
hours AS (SELECT station, city, unnest(generate_series(g0, g1, INTERVAL 1 HOUR))::TIMESTAMP AS ts FROM bounds),
grid AS (SELECT * FROM hours LEFT JOIN hourly USING (station, city, ts)),
filled AS (SELECT *, avg(aqi) OVER (PARTITION BY station, city) AS m, lag(aqi, 24) OVER (PARTITION BY station, city ORDER BY ts) AS l24 FROM grid)
SELECT * FROM (SELECT station, city, ts, aqi::DOUBLE AS aqi,
 round(coalesce(first_value(l24 IGNORE NULLS) OVER (PARTITION BY station, city ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), m), 9) AS aqi_lag_24h,
 round(coalesce(avg(aqi) OVER w, m), 9) AS aqi_roll_mean_24h, round(coalesce(stddev_samp(aqi) OVER w, m), 9) AS aqi_roll_std_24h,
 coalesce(max(aqi) OVER w, m)::DOUBLE AS aqi_roll_max_24h
 FROM filled WINDOW w AS (PARTITION BY station, city ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)) WHERE aqi IS NOT NULL""")
def station_series_features(spark, sf):
    """The minimum feature set on many sparse series (station by city)."""
    from hourgrid.operators.rollup import hourly_mean

    keys = ["station", "city"]
    rows = hourly_mean(readings(spark, sf), keys, "ts", "pm25", decimals=2)
    rows = rows.select(*keys, "ts", ix.pm25_to_aqi(F.col("pm25")).cast("double").alias("aqi"))
    out = with_series_windows(saved(rows, "station-hours"), keys, "ts", "aqi", lags=[24], windows=[(24, "24h")])
    return _rounded(out, ["aqi_lag_24h", "aqi_roll_mean_24h", "aqi_roll_std_24h"])


@query("daily_series_calendar", with_ctes(DAILY_CTE) + f"""
SELECT city, ds, round(y, 9) AS y, {CALENDAR_SQL.format(t='ds')}, {SEASON_SQL.format(t='ds')} FROM daily""")
def _(spark, sf):
    out = tf.with_cyclic(tf.with_calendar(tf.with_season_effects(daily_plan(spark, sf))))
    return _rounded(out, ["y", *CYCLIC])
