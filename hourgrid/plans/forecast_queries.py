"""Queries on splits, forecasts, metrics, calibration and promotion."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.functions.index import aqi_label, whole_index
from hourgrid.operators import autoregression, forecast, lookups, metrics, registry, regression
from hourgrid.operators.features import feature_table
from hourgrid.plans.bindings import (
    DAILY_CTE, HOURLY_CTE, KEYS, WEATHER_CTE, daily_orders, hourly, label_sql, readings, table, weather,
    weather_plan, with_ctes)
from hourgrid.plans.catalog import query
from hourgrid.session import saved

AS_OF = "2024-01-25 12:30:00"

SPLIT_CTE = """series AS (SELECT city, ts AS ds, aqi::DOUBLE AS y,
  CASE WHEN ts > max(ts) OVER (PARTITION BY city) - INTERVAL 7 DAY THEN 'test' ELSE 'train' END AS split FROM hourly)"""
NAIVE_CTE = """lagged AS (SELECT a.*, b.y AS lag FROM series a LEFT JOIN series b ON a.city = b.city AND b.ds = a.ds - INTERVAL 24 HOUR),
weekly AS (SELECT city, isodow(ds) AS dow, hour(ds) AS hod, avg(y) AS wk FROM series WHERE split = 'train' GROUP BY ALL),
overall AS (SELECT city, avg(y) AS ov FROM series WHERE split = 'train' GROUP BY city),
point AS (SELECT l.*, hour(ds) AS hod, least(greatest(coalesce(lag, wk, ov), 0), 500) AS yhat FROM lagged l
 LEFT JOIN weekly w ON l.city = w.city AND isodow(l.ds) = w.dow AND hour(l.ds) = w.hod LEFT JOIN overall o ON l.city = o.city),
spread AS (SELECT city, hod, quantile_cont(y - yhat, 0.025) AS lo, quantile_cont(y - yhat, 0.975) AS hi
 FROM point WHERE split = 'train' AND lag IS NOT NULL GROUP BY ALL),
naive AS (SELECT p.city, ds, y, split, round(yhat, 9) AS yhat, round(least(greatest(yhat + coalesce(lo, 0), 0), 500), 9) AS yhat_lower,
 round(least(greatest(yhat + coalesce(hi, 0), 0), 500), 9) AS yhat_upper FROM point p LEFT JOIN spread q ON p.city = q.city AND p.hod = q.hod)"""
NAIVE = with_ctes(HOURLY_CTE, SPLIT_CTE, NAIVE_CTE)


def _rounded(df, names):
    return df.withColumns({n: F.round(n, 9) for n in names})


def _series(spark, sf):
    rows = hourly(spark, sf).select("city", F.col("ts").alias("ds"), F.col("aqi").cast("double").alias("y"))
    return metrics.split_by_time(rows, KEYS, test_days=7)


def _naive_plan(spark, sf):
    out = forecast.seasonal_naive(_series(spark, sf), KEYS)
    return _rounded(out, ["yhat", "yhat_lower", "yhat_upper"])


def _naive(spark, sf):
    return saved(_naive_plan(spark, sf), "naive")


@query("train_test_split", with_ctes(HOURLY_CTE, SPLIT_CTE) + """
SELECT city, ds, y, CASE WHEN count(*) FILTER (WHERE split = 'test') OVER (PARTITION BY city) < 24 THEN 'short' ELSE split END AS split FROM series""")
def _(spark, sf):
    rows = hourly(spark, sf).select("city", F.col("ts").alias("ds"), F.col("aqi").cast("double").alias("y"))
    return metrics.split_by_time(rows, KEYS, test_days=7, min_test_rows=24)


@query("seasonal_naive_forecast", NAIVE + "SELECT * FROM naive")
def seasonal_naive_forecast(spark, sf):
    return _naive_plan(spark, sf)


METRICS_SQL = """avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat)*(y - yhat))) AS rmse, avg(abs((y - yhat)/(y + 1e-8::DOUBLE)))*100 AS mape_eps,
 avg(abs(y - yhat)/greatest(abs(y), 1))*100 AS mape_clip"""
MATCH = f"({label_sql('y')} = {label_sql('yhat')})"
NEAR = "(least(abs(y - 50), abs(y - 100), abs(y - 200), abs(y - 300), abs(y - 400)) <= 10)"
REPORT_CTE = f"""report0 AS (SELECT city, count(*)::BIGINT AS test_rows, min(ds)::DATE AS test_from, max(ds)::DATE AS test_to, {METRICS_SQL},
 avg((y BETWEEN yhat_lower AND yhat_upper)::INTEGER)*100 AS coverage_95, avg({MATCH}::INTEGER)*100 AS category_accuracy,
 avg((NOT {MATCH} AND {NEAR})::INTEGER)*100 AS boundary_error_rate,
 coalesce(avg({MATCH}::INTEGER) FILTER (WHERE NOT {NEAR})*100, 0) AS category_accuracy_ex_boundary,
 coalesce(avg((y BETWEEN yhat_lower AND yhat_upper)::INTEGER) FILTER (WHERE NOT {NEAR})*100, 0) AS coverage_95_ex_boundary,
 avg(abs(y - yhat)) FILTER (WHERE hour(ds) BETWEEN 7 AND 10 OR hour(ds) BETWEEN 17 AND 20) AS rush_hour_mae,
 avg(y) AS mean_actual_aqi, avg(yhat) AS mean_pred_aqi FROM naive WHERE split = 'test' GROUP BY city)"""
REPORT_NUMBERS = ["mae", "rmse", "mape_eps", "mape_clip", "coverage_95", "category_accuracy", "boundary_error_rate",
                  "category_accuracy_ex_boundary", "coverage_95_ex_boundary", "rush_hour_mae", "mean_actual_aqi",
                  "mean_pred_aqi", "calibration_gap", "boundary_share_of_errors"]


def _test(spark, sf):
    return _naive_plan(spark, sf).filter("split = 'test'")


@query("eval_report", NAIVE + ", " + REPORT_CTE + """
SELECT city, test_rows, test_from, test_to, """ + ", ".join(f"round({n}, 9) AS {n}" for n in REPORT_NUMBERS[:-2]) + """,
 round(greatest(0, 95 - coverage_95), 9) AS calibration_gap,
 round(CASE WHEN 100 - category_accuracy > 0 THEN boundary_error_rate/(100 - category_accuracy) ELSE 0 END, 9) AS boundary_share_of_errors FROM report0""")
def eval_report(spark, sf):
    return _rounded(metrics.evaluate(_test(spark, sf), KEYS), REPORT_NUMBERS)


@query("eval_average", NAIVE + ", " + REPORT_CTE + """
SELECT count(*)::BIGINT AS series, round(avg(mae), 9) AS mae, round(avg(rmse), 9) AS rmse, round(avg(mape_clip), 9) AS mape_clip,
 round(avg(coverage_95), 9) AS coverage_95, bool_and(mae <= 50) AS all_passed FROM report0""")
def _(spark, sf):
    out = metrics.average_row(metrics.evaluate(_test(spark, sf), KEYS))
    return _rounded(out, ["mae", "rmse", "mape_clip", "coverage_95"])


@query("calibration_bins", NAIVE + """
, w AS (SELECT *, round(yhat_upper - yhat_lower, 6) AS width FROM naive WHERE split = 'test'),
e AS (SELECT city, quantile_cont(width, 0.0) AS e0, quantile_cont(width, 0.2) AS e1, quantile_cont(width, 0.4) AS e2,
  quantile_cont(width, 0.6) AS e3, quantile_cont(width, 0.8) AS e4, quantile_cont(width, 1.0) AS e5 FROM w GROUP BY city),
edges AS (SELECT city, b AS bin, CASE b WHEN 1 THEN e0 WHEN 2 THEN e1 WHEN 3 THEN e2 WHEN 4 THEN e3 ELSE e4 END AS width_low,
  CASE b WHEN 1 THEN e1 WHEN 2 THEN e2 WHEN 3 THEN e3 WHEN 4 THEN e4 ELSE e5 END AS width_high FROM e, (SELECT unnest(range(1, 6))::INTEGER AS b))
SELECT x.city, x.bin, round(width_low, 9) AS width_low, round(width_high, 9) AS width_high, count(w.ds)::BIGINT AS count,
 round(avg((y BETWEEN yhat_lower AND yhat_upper)::INTEGER)*100, 9) AS coverage
FROM edges x LEFT JOIN w ON x.city = w.city AND w.width >= x.width_low AND (w.width < x.width_high OR (x.bin = 5 AND w.width <= x.width_high))
GROUP BY ALL""")
def calibration_bins(spark, sf):
    rows = _naive(spark, sf).filter("split = 'test'")
    # widths in whole millionths on both engines, so that bin edges do not hang on the last bit
    return _rounded(metrics.calibration_bins(rows, KEYS, decimals=6), ["width_low", "width_high", "coverage"])


@query("forecast_metrics", NAIVE + ", m AS (SELECT city, split, " + METRICS_SQL + """ FROM naive GROUP BY ALL)
SELECT city, round(a.mae, 9) AS train_mae, round(a.rmse, 9) AS train_rmse, round(a.mape_eps, 9) AS train_mape,
 round(b.mae, 9) AS test_mae, round(b.rmse, 9) AS test_rmse, round(b.mape_eps, 9) AS test_mape,
 round(b.mae - a.mae, 9) AS gap_mae, round(b.rmse - a.rmse, 9) AS gap_rmse, round(b.mape_eps - a.mape_eps, 9) AS gap_mape
FROM (SELECT * FROM m WHERE split = 'train') a JOIN (SELECT * FROM m WHERE split = 'test') b USING (city)""")
def _(spark, sf):
    out = metrics.split_metrics(_naive_plan(spark, sf), KEYS)
    return _rounded(out, [c for c in out.columns if c != "city"])


@query("model_comparison", NAIVE + """
, model AS (SELECT city, avg(abs(y - yhat)) AS mae FROM naive WHERE split = 'test' GROUP BY city),
base AS (SELECT n.city, avg(abs(y - ov)) AS mae FROM naive n JOIN overall o USING (city) WHERE split = 'test' GROUP BY n.city)
SELECT m.city, round(m.mae, 9) AS model_mae, round(b.mae, 9) AS baseline_mae, round((b.mae - m.mae)/b.mae*100, 9) AS improvement_pct
FROM model m LEFT JOIN base b USING (city)""")
def _(spark, sf):
    rows = _naive(spark, sf)
    means = rows.filter("split = 'train'").groupBy("city").agg(F.avg("y").alias("flat"))
    test = rows.filter("split = 'test'").join(means, "city")
    mae = lambda column: F.avg(F.abs(F.col("y") - F.col(column))).alias("mae")
    model, base = (test.groupBy("city").agg(mae(c)) for c in ("yhat", "flat"))
    return _rounded(metrics.improvement(model, base, KEYS), ["model_mae", "baseline_mae", "improvement_pct"])


@query("forecast_headline", NAIVE + """
, day AS (SELECT city, ds, round_even(yhat, 0)::INTEGER AS aqi, row_number() OVER (PARTITION BY city ORDER BY ds) AS r FROM naive WHERE split = 'test')
SELECT city, round(avg(aqi) FILTER (WHERE r <= 6), 9) AS next_6h_avg, max(aqi) AS peak, min(aqi) AS low FROM day WHERE r <= 24 GROUP BY city""")
def _(spark, sf):
    rows = _test(spark, sf).select("city", "ds", whole_index(F.col("yhat")).alias("aqi"))
    first = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    day = forecast.next_hours(rows, KEYS, "ds", first, n=24)
    return _rounded(forecast.forecast_headline(day, KEYS, "ds", "aqi"), ["next_6h_avg"])


@query("forecast_output", NAIVE + f"""
SELECT city, strftime(ds, '%Y-%m-%dT%H:%M:%S') AS timestamp, strftime(ds + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS timestamp_ist,
 round_even(yhat, 0)::INTEGER AS aqi, round_even(yhat_lower, 0)::INTEGER AS aqi_lower, round_even(yhat_upper, 0)::INTEGER AS aqi_upper,
 {label_sql('round_even(yhat, 0)')} AS label FROM naive WHERE split = 'test'""")
def _(spark, sf):
    out = forecast.forecast_output(_test(spark, sf), KEYS)
    return out.withColumn("label", F.col("category.label")).drop("category")


VERSIONS_CTE = """versions AS (SELECT city, (date_diff('day', DATE '1995-01-01', a.ds::DATE) // 30)::INTEGER AS version,
  avg(abs(a.y - b.y)) AS mae FROM daily a JOIN daily b USING (city) WHERE b.ds = a.ds - INTERVAL 1 DAY GROUP BY ALL),
ranked AS (SELECT *, min(mae) OVER (PARTITION BY city ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS champion_mae_before FROM versions),
history AS (SELECT *, mae < coalesce(champion_mae_before, 'inf'::DOUBLE) AS promoted FROM ranked)"""


def _versions(spark, sf):
    """One version per 30 days of orders, scored by its day-before forecast error."""
    daily = daily_orders(spark, sf)
    before = daily.select("city", (F.col("ds") + F.expr("INTERVAL 1 DAY")).alias("ds"), F.col("y").alias("yhat"))
    version = F.floor(F.date_diff("ds", F.lit("1995-01-01").cast("date")) / 30).cast("int")
    return saved(daily.join(before, ["city", "ds"]).groupBy("city", version.alias("version"))
                 .agg(F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae")), "versions")


@query("champion_history", with_ctes(DAILY_CTE, VERSIONS_CTE) + """
SELECT *, CASE WHEN version = max(version) FILTER (WHERE promoted) OVER (PARTITION BY city) THEN 'champion'
 WHEN promoted THEN 'retired' ELSE 'challenger' END AS status FROM history""")
def champion_history(spark, sf):
    return registry.champion_history(_versions(spark, sf), KEYS)


@query("champion_lookup", with_ctes(DAILY_CTE, VERSIONS_CTE) + """
SELECT city, version, coalesce(mae, 'inf'::DOUBLE) AS mae, version IS NOT NULL AS loaded
FROM (SELECT DISTINCT o_orderpriority AS city FROM orders UNION SELECT DISTINCT event_type FROM events)
LEFT JOIN (SELECT city, max(version) AS version, arg_max(mae, version) AS mae FROM history WHERE promoted GROUP BY city) USING (city)""")
def _(spark, sf):
    history = registry.champion_history(_versions(spark, sf), KEYS)
    return registry.champion_lookup(_registered(spark, sf), history, KEYS)


def _registered(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("city"))
    return orders.union(readings(spark, sf).select("city")).distinct()


@query("missing_models", """
SELECT DISTINCT event_type AS city FROM events EXCEPT SELECT o_orderpriority FROM orders""")
def _(spark, sf):
    history = registry.champion_history(_versions(spark, sf), KEYS)
    return registry.missing_champions(_registered(spark, sf), history, KEYS)


@query("promotion_counts", with_ctes(DAILY_CTE, VERSIONS_CTE) + """
SELECT city, count(*) FILTER (WHERE promoted)::BIGINT AS promoted, count(*)::BIGINT AS trained FROM history GROUP BY city""")
def _(spark, sf):
    return registry.promotion_counts(registry.champion_history(_versions(spark, sf), KEYS), KEYS)


@query("future_weather", with_ctes(WEATHER_CTE) + f"""
SELECT city, ts, round(temperature_2m, 9) AS temperature_2m FROM (
 SELECT *, row_number() OVER (PARTITION BY city ORDER BY ts) AS r FROM weather WHERE ts >= TIMESTAMP '{AS_OF}') WHERE r <= 24""")
def _(spark, sf):
    out = forecast.next_hours(weather_plan(spark, sf), KEYS, "ts", F.lit(AS_OF).cast("timestamp_ntz"))
    return _rounded(out, ["temperature_2m"]).drop("wind_speed_10m")


@query("future_frame", with_ctes(HOURLY_CTE, WEATHER_CTE) + f"""
, series AS (SELECT DISTINCT event_type AS city FROM events),
fut AS (SELECT city, unnest(generate_series(date_trunc('hour', TIMESTAMP '{AS_OF}'), date_trunc('hour', TIMESTAMP '{AS_OF}') + INTERVAL 23 HOUR, INTERVAL 1 HOUR))::TIMESTAMP AS ds FROM series),
past AS (SELECT * FROM weather WHERE ts <= TIMESTAMP '{AS_OF}'),
wd AS (SELECT city, date_trunc('day', ts) AS d FROM past GROUP BY city, d QUALIFY row_number() OVER (PARTITION BY city ORDER BY d DESC) <= 7),
wm AS (SELECT p.city, avg(temperature_2m) AS tm, avg(wind_speed_10m) AS wm FROM past p JOIN wd ON p.city = wd.city AND date_trunc('day', p.ts) = wd.d GROUP BY p.city),
ph AS (SELECT * FROM hourly WHERE ts <= TIMESTAMP '{AS_OF}'),
hd AS (SELECT city, date_trunc('day', ts) AS d FROM ph GROUP BY city, d QUALIFY row_number() OVER (PARTITION BY city ORDER BY d DESC) <= 7),
hm AS (SELECT p.city, avg(aqi) AS rm FROM ph p JOIN hd ON p.city = hd.city AND date_trunc('day', p.ts) = hd.d GROUP BY p.city),
cur AS (SELECT city, arg_max(aqi, ts)::DOUBLE AS cv FROM ph GROUP BY city)
SELECT f.city, ds, round(coalesce(wind_speed_10m, wm, 0), 9) AS wind_speed_10m, round(coalesce(temperature_2m, tm, 0), 9) AS temperature_2m,
 0.0::DOUBLE AS relative_humidity_2m, coalesce(cv, 100) AS aqi_lag_24h, round(coalesce(rm, 100), 9) AS aqi_roll_mean_24h,
 (hour(ds) BETWEEN 7 AND 10 OR hour(ds) BETWEEN 17 AND 20)::INTEGER AS is_rush_hour,
 0.0::DOUBLE AS crop_burning, 0.0::DOUBLE AS festival_period, 0.0::DOUBLE AS temp_inversion
FROM fut f LEFT JOIN weather w ON f.city = w.city AND f.ds = w.ts LEFT JOIN wm ON f.city = wm.city LEFT JOIN hm ON f.city = hm.city LEFT JOIN cur ON f.city = cur.city""")
def future_frame(spark, sf):
    moment = F.lit(AS_OF).cast("timestamp_ntz")
    hours, wx = hourly(spark, sf), weather(spark, sf)
    past, past_wx = hours.filter(F.col("ts") <= moment), wx.filter(F.col("ts") <= moment)
    out = forecast.future_frame(
        hours.select("city").distinct(), KEYS, moment, 24, wx,
        lookups.recent_mean(past_wx, KEYS, "ts", ["temperature_2m", "wind_speed_10m"]),
        lookups.last_known(past, KEYS, "ts", ["aqi"]).withColumnRenamed("aqi", "value"),
        lookups.recent_mean(past, KEYS, "ts", ["aqi"]).withColumnRenamed("aqi", "value"))
    out = out.withColumn("aqi_lag_24h", F.col("aqi_lag_24h").cast("double"))
    return _rounded(out, ["wind_speed_10m", "temperature_2m", "aqi_roll_mean_24h"])


@query("ridge_forecast")
def ridge_forecast(spark, sf):
    """Additive seasonal regression with regressors: fitted on the older part, scored on the rest."""
    model = regression.SeasonalModel(regressors=(
        "wind_speed_10m", "temperature_2m", "aqi_lag_24h", "aqi_roll_mean_24h", "is_rush_hour"))
    features = saved(feature_table(hourly(spark, sf), KEYS, weather=weather(spark, sf)).select(
        "city", "ds", "y", *model.regressors), "features")
    rows = metrics.split_by_time(features, KEYS)
    fitted = regression.fit(rows.filter("split = 'train'"), KEYS, model=model)
    scored = regression.predict(rows.filter("split = 'test'"), fitted, KEYS, model=model)
    return scored.select("city", "ds", "y", *[F.round(c, 6).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")],
                         aqi_label(F.col("yhat")).alias("label"))


@query("ridge_daily_orders")
def ridge_daily_orders(spark, sf):
    """Trend and seasonalities on the multi-year order series, scored per series."""
    model = regression.SeasonalModel(seasonalities=((7.0, 3), (365.25, 10), (365.25 / 4, 5)), regressors=())
    # in thousands: forecasts are clipped to the index range of 0..500
    daily = daily_orders(spark, sf).withColumn("y", F.col("y") / 1000)
    rows = metrics.split_by_time(daily, KEYS, test_days=30)
    fitted = regression.fit(rows.filter("split = 'train'"), KEYS, model=model)
    scored = regression.predict(rows, fitted, KEYS, model=model)
    return _rounded(metrics.split_metrics(scored, KEYS), ["train_mae", "test_mae"]).select(
        "city", "train_mae", "test_mae")


THOUSANDS = """d AS (SELECT a.city, a.ds, a.y/1000 AS y, epoch(a.ds)::DOUBLE AS e, b.n::DOUBLE AS n FROM daily a
 JOIN (SELECT o_orderpriority AS city, o_orderdate AS ds, count(*) AS n FROM orders GROUP BY ALL) b ON a.city = b.city AND a.ds = b.ds),
r AS (SELECT city, min(e) AS t0, max(e) AS t1, max(abs(y)) AS scale, avg(n) AS m, coalesce(nullif(stddev_pop(n), 0), 1) AS s,
  count(*)::DOUBLE AS rows FROM d GROUP BY city),
x AS (SELECT d.*, r.scale, r.rows, (e - t0)/greatest(t1 - t0, 1) AS t, (n - m)/s AS z FROM d JOIN r USING (city))"""


def _thousands(spark, sf):
    """Daily order values in thousands, which keeps forecasts inside the index range, and the number of orders."""
    counts = table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("city"), F.col("o_orderdate").alias("ds")).agg(F.count("*").cast("double").alias("n"))
    return daily_orders(spark, sf).withColumn("y", F.col("y") / 1000).join(counts, ["city", "ds"])


def _fitted(rows, model):
    out = regression.predict(rows, regression.fit(rows, KEYS, model=model), KEYS, model=model)
    return out.select("city", "ds", *[F.round(c, 6).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])


BAND = ", ".join(f"round(least(greatest({v}, 0), 500), 6) AS {n}" for n, v in (
    ("yhat", "p"), ("yhat_lower", f"p - {regression.Z_95}::DOUBLE*sg"), ("yhat_upper", f"p + {regression.Z_95}::DOUBLE*sg")))


@query("ridge_trend", with_ctes(DAILY_CTE, THOUSANDS) + f"""
, f AS (SELECT city, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM x GROUP BY city),
g AS (SELECT x.city, ds, a + b*t AS p, sqrt(avg((y - a - b*t)*(y - a - b*t)) OVER (PARTITION BY x.city)) AS sg FROM x JOIN f ON x.city = f.city)
SELECT city, ds, {BAND} FROM g""")
def ridge_trend(spark, sf):
    """Level and slope alone carry no penalty: a plain line."""
    return _fitted(_thousands(spark, sf), regression.SeasonalModel(seasonalities=(), changepoints=0, regressors=()))


@query("ridge_one_regressor", with_ctes(DAILY_CTE, THOUSANDS) + f"""
, c AS (SELECT city, avg(t) AS mt, avg(z) AS mz, avg(y/scale) AS my, rows*var_pop(t) AS tt, rows*covar_pop(t, z) AS tz, rows*var_pop(z) + 0.01 AS zz,
  rows*covar_pop(t, y/scale) AS ty, rows*covar_pop(z, y/scale) AS zy FROM x GROUP BY city, rows),
f AS (SELECT *, (ty*zz - zy*tz)/(tt*zz - tz*tz) AS b, (zy*tt - ty*tz)/(tt*zz - tz*tz) AS w FROM c),
g AS (SELECT x.city, ds, y, scale*(my - b*mt - w*mz + b*t + w*z) AS p FROM x JOIN f ON x.city = f.city),
h AS (SELECT *, sqrt(avg((y - p)*(y - p)) OVER (PARTITION BY city)) AS sg FROM g)
SELECT city, ds, {BAND} FROM h""")
def ridge_one_regressor(spark, sf):
    """A penalised regressor beside the line: the two-by-two system of the centred sums."""
    return _fitted(_thousands(spark, sf), regression.SeasonalModel(seasonalities=(), changepoints=0, regressors=("n",)))


KNOT, CHANGE_PRIOR = 0.4, 1.0


@query("sparse_trend", with_ctes(DAILY_CTE, THOUSANDS) + f"""
, h AS (SELECT city, scale, t, y/scale AS y, greatest(0, t - {KNOT}::DOUBLE) AS h FROM x),
c AS (SELECT city, max(scale) AS scale, count(*) AS n, avg(t) AS mt, avg(h) AS mh, avg(y) AS my, count(*)*var_pop(t) AS tt, count(*)*covar_pop(t, h) AS th,
  count(*)*var_pop(h) AS hh, count(*)*covar_pop(t, y) AS ty, count(*)*covar_pop(h, y) AS hy FROM h GROUP BY city),
q AS (SELECT *, hy - th*ty/tt AS pull, hh - th*th/tt AS size FROM c),
s AS (SELECT *, sign(pull)*greatest(abs(pull) - {1 / CHANGE_PRIOR}::DOUBLE, 0)/size AS change FROM q)
SELECT city, round((ty - change*th)/tt, 6) AS slope, round(change, 6) AS change, round(my - (ty - change*th)/tt*mt - change*mh, 6) AS level FROM s""")
def sparse_trend(spark, sf):
    """One possible change of the slope with an absolute penalty: zero, or shrunk by as much as the penalty."""
    model = regression.SeasonalModel(seasonalities=(), changepoints=1, changepoint_range=KNOT, changepoint_prior=CHANGE_PRIOR,
                                     changepoint_shape="laplace", noise_variance=1.0, regressors=())
    found = regression.fit(_thousands(spark, sf), KEYS, model=model)
    level, slope, change = (F.round(F.col("coefficients")[i], 6) for i in range(3))
    return found.select("city", slope.alias("slope"), (change + 0.0).alias("change"), level.alias("level"))


GRAM = ["1::DOUBLE", "t", "sin(e/86400*(2*pi()/7))", "cos(e/86400*(2*pi()/7))", "y/scale"]


@query("ridge_gram", with_ctes(DAILY_CTE, THOUSANDS) + "SELECT city, i::INTEGER AS cell, round(v, 6) AS value FROM (SELECT city, unnest(range(15)) AS i, unnest([" + ", ".join(
    f"sum({a}*{b})" for i, a in enumerate(GRAM) for b in GRAM[i:]) + "]) AS v FROM x GROUP BY city)")
def ridge_gram(spark, sf):
    """The summed sufficient statistics of a weekly cycle, cell by cell."""
    model = regression.SeasonalModel(seasonalities=((7.0, 1),), changepoints=0, regressors=())
    rows = _thousands(spark, sf)
    cells = regression.gram_cells(rows, regression._scaling(rows, KEYS, "ds", "y", ()), KEYS, "ds", "y", model)
    return cells.select(F.get_json_object("__key", "$.city").alias("city"), F.col("__i").alias("cell"),
                        F.round("__v", 6).alias("value"))


WEEKLY = autoregression.Orders(season=7, long=2, own=(1,), shocks=(1,), step=24, gap=0)
SHOCKS_CTE = """dd AS (SELECT city, ds::DATE AS d, y/1000 AS y FROM daily),
w AS (SELECT a.city, a.d, a.y - b.y - c.y + e.y AS w FROM dd a JOIN dd b ON b.city = a.city AND b.d = a.d - 1
 JOIN dd c ON c.city = a.city AND c.d = a.d - 7 JOIN dd e ON e.city = a.city AND e.d = a.d - 8),
l AS (SELECT a.*, b.w AS w1, c.w AS w2 FROM w a JOIN w b ON b.city = a.city AND b.d = a.d - 1 JOIN w c ON c.city = a.city AND c.d = a.d - 2),
s1 AS (SELECT city, count(*) AS n, sum(w1*w1) AS g, sum(w1*w2) AS k, sum(w2*w2) AS h, sum(w*w1) AS s, sum(w*w2) AS t FROM l GROUP BY city),
p AS (SELECT d.city, CASE WHEN n > 4 THEN (s*h - t*k)/(g*h - k*k) ELSE 0 END AS p1, CASE WHEN n > 4 THEN (t*g - s*k)/(g*h - k*k) ELSE 0 END AS p2
 FROM (SELECT DISTINCT city FROM dd) d LEFT JOIN s1 ON s1.city = d.city),
e AS (SELECT l.city, l.d, l.w, w - p1*w1 - p2*w2 AS e FROM l JOIN p ON p.city = l.city),
m AS (SELECT a.city, a.w, e.w AS w1, e.e AS e1 FROM w a JOIN e ON e.city = a.city AND e.d = a.d - 1),
s2 AS (SELECT city, count(*) AS n, sum(w1*w1) AS g, sum(w1*e1) AS k, sum(e1*e1) AS h, sum(w*w1) AS s, sum(w*e1) AS t FROM m GROUP BY city),
q AS (SELECT p.*, coalesce(n, 0) AS n, CASE WHEN n > 4 THEN (s*h - t*k)/(g*h - k*k) ELSE 0 END AS own, CASE WHEN n > 4 THEN (t*g - s*k)/(g*h - k*k) ELSE 0 END AS shock
 FROM p LEFT JOIN s2 ON s2.city = p.city)
SELECT q.city, round(p1, 6) AS long_1, round(p2, 6) AS long_2, round(own, 6) AS own, round(shock, 6) AS shock,
 round(coalesce((SELECT sqrt(avg((m.w - own*m.w1 - shock*m.e1)*(m.w - own*m.w1 - shock*m.e1))) FROM m WHERE m.city = q.city), 0), 6) AS sigma, n AS rows FROM q"""


@query("arma_stages", with_ctes(DAILY_CTE, SHOCKS_CTE))
def arma_stages(spark, sf):
    """Both stages of the autoregressive baseline on weekly differences of the daily order series."""
    daily = daily_orders(spark, sf).withColumn("y", F.col("y") / 1000)
    found = autoregression.fit(daily, KEYS, orders=WEEKLY)
    cells = {"long_1": F.col("long")[0], "long_2": F.col("long")[1], "own": F.col("coefficients")[0],
             "shock": F.col("coefficients")[1], "sigma": F.col("sigma")}
    return found.select("city", *[(F.round(c, 6) + 0.0).alias(n) for n, c in cells.items()], "rows")


@query("arma_forecast")
def arma_forecast(spark, sf):
    """The autoregressive baseline with a season of a day, trained before the last seven days and scored on them."""
    rows = saved(_series(spark, sf), "series")
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    ahead = autoregression.predict(train, autoregression.fit(train, KEYS), KEYS, steps=7 * 24)
    return _rounded(test.select("city", "ds", "y").join(ahead, ["city", "ds"]), ["yhat", "yhat_lower", "yhat_upper"])
