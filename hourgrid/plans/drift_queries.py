"""Queries on baselines, drift and retraining."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.operators import baseline, drift
from hourgrid.operators.quantiles import SKETCH_ERROR, day_sketches, exact_quantiles, merged_quantiles
from hourgrid.plans.bindings import (
    DAILY_CTE, HOURLY_CTE, KEYS, WEATHER_CTE, daily_orders, daily_plan, hourly_plan, index_sql, readings, table,
    weather_plan, with_ctes)
from hourgrid.plans.catalog import query
from hourgrid.session import saved

AS_OF = "2024-01-30 12:00:00"


def _features(spark, sf):
    return hourly_plan(spark, sf).select("city", F.col("ts").alias("ds"), F.col("aqi").cast("double").alias("y"))


def _rounded(df, names):
    return df.withColumns({n: F.round(n, 9) for n in names})


STATS = ["aqi_mean", "aqi_std", "aqi_median", "aqi_p25", "aqi_p75", "aqi_p95"]


@query("baseline_stats", with_ctes(HOURLY_CTE, WEATHER_CTE) + """
SELECT city, count(aqi)::BIGINT AS n_samples, round(avg(aqi), 9) AS aqi_mean, round(stddev_samp(aqi), 9) AS aqi_std,
 round(quantile_cont(aqi::DOUBLE, 0.5), 9) AS aqi_median, round(quantile_cont(aqi::DOUBLE, 0.25), 9) AS aqi_p25,
 round(quantile_cont(aqi::DOUBLE, 0.75), 9) AS aqi_p75, round(quantile_cont(aqi::DOUBLE, 0.95), 9) AS aqi_p95,
 min(aqi)::DOUBLE AS aqi_min, max(aqi)::DOUBLE AS aqi_max, round(avg(wind_speed_10m), 9) AS wind_mean, round(avg(temperature_2m), 9) AS temp_mean
FROM hourly LEFT JOIN weather USING (city, ts) GROUP BY city""")
def _(spark, sf):
    rows = saved(_features(spark, sf).join(
        weather_plan(spark, sf).withColumnRenamed("ts", "ds"), ["city", "ds"], "left"), "features")
    out = baseline.baseline_stats(rows, KEYS, weather_means=["wind_speed_10m", "temperature_2m"])
    return _rounded(out, [*STATS, "wind_mean", "temp_mean"])


@query("order_value_quantiles", """
SELECT o_orderpriority AS city, round(quantile_cont(o_totalprice, 0.25), 9) AS p25, round(quantile_cont(o_totalprice, 0.5), 9) AS p50,
 round(quantile_cont(o_totalprice, 0.95), 9) AS p95 FROM orders GROUP BY 1""")
def order_value_quantiles(spark, sf):
    """Exact quantiles of raw values that are nearly all distinct."""
    rows = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("city"), "o_totalprice")
    q = exact_quantiles(rows, KEYS, "o_totalprice", [0.25, 0.5, 0.95], "q")
    return q.select("city", *[F.round(F.col("q")[i], 9).alias(n) for i, n in enumerate(["p25", "p50", "p95"])])


SKETCH_PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]


@query("sketch_quantiles", "SELECT event_type AS city, count(value)::BIGINT AS n, p AS prob, true AS within FROM events, (SELECT unnest("
       + f"{SKETCH_PROBS}::DOUBLE[]) AS p) GROUP BY ALL")
def sketch_quantiles(spark, sf):
    """Quantiles from sketches that are stored per day and merged; their ranks are checked against all rows."""
    rows = readings(spark, sf)
    stored = saved(day_sketches(rows, KEYS, "ts", "pm25"), "sketches")
    found = merged_quantiles(stored, KEYS, SKETCH_PROBS).withColumnRenamed("city", "c")
    below = [F.count_if(F.col("pm25") <= F.col("quantiles")[i]).alias(f"b{i}") for i in range(len(SKETCH_PROBS))]
    equal = [F.count_if(F.col("pm25") == F.col("quantiles")[i]).alias(f"e{i}") for i in range(len(SKETCH_PROBS))]
    ranks = rows.join(found, F.col("city") == F.col("c")).groupBy("city", "n").agg(*below, *equal)
    each = F.explode(F.array(*(F.struct(F.lit(p).alias("prob"), F.col(f"b{i}").alias("b"), F.col(f"e{i}").alias("e"))
                               for i, p in enumerate(SKETCH_PROBS))))
    rank = ranks.select("city", "n", each.alias("r")).select("city", "n", "r.prob", "r.b", "r.e")
    within = (F.col("b") >= (F.col("prob") - SKETCH_ERROR) * F.col("n")) & (F.col("b") - F.col("e") <= (F.col("prob") + SKETCH_ERROR) * F.col("n"))
    return rank.select("city", "n", "prob", within.alias("within"))


@query("baseline_months", with_ctes(DAILY_CTE) + """
SELECT city, month(ds)::INTEGER AS month, count(*)::BIGINT AS "rows", count(*) >= 100 AS has_baseline FROM daily GROUP BY ALL""")
def _(spark, sf):
    return baseline.month_counts(daily_plan(spark, sf), KEYS)


@query("baseline_monthly", with_ctes(DAILY_CTE) + """
SELECT city, ds, round(y, 9) AS aqi, month(ds)::INTEGER AS month FROM daily
QUALIFY count(*) OVER (PARTITION BY city, month(ds)) >= 100""")
def _(spark, sf):
    return _rounded(baseline.monthly_baseline(daily_orders(spark, sf), KEYS), ["aqi"])


RECENT_SQL = f"""raw AS (SELECT event_type AS city, ts, {index_sql('value')} AS aqi FROM events),
recent AS (SELECT city, date_trunc('hour', ts)::TIMESTAMP AS ts, avg(aqi) AS aqi FROM raw
 WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND ts <= TIMESTAMP '{AS_OF}' GROUP BY ALL)"""


def _drift_sql(base: str, kind: str, recent: str = "recent") -> str:
    """Two-sample KS in SQL: hash-ordered sample, cumulative counts, exact path-count p-value."""
    return f"""
base AS ({base}),
rn AS (SELECT city, count(*) AS n, avg(aqi) AS m FROM {recent} GROUP BY city),
bn AS (SELECT city, count(*) AS n, avg(aqi) AS m FROM base GROUP BY city),
guard AS (SELECT c.city, coalesce(rn.n, 0) AS recent_n, rn.m AS recent_mean, bn.m AS baseline_mean,
  CASE WHEN coalesce(bn.n, 0) = 0 THEN 'Baseline not found'
   WHEN coalesce(rn.n, 0) < 24 THEN 'Insufficient recent data: ' || coalesce(rn.n, 0) || ' samples (need 24)' END AS error
 FROM (SELECT DISTINCT event_type AS city FROM events) c LEFT JOIN bn USING (city) LEFT JOIN rn USING (city)),
sample AS (SELECT city, aqi FROM (SELECT b.city, b.aqi, g.recent_n,
   row_number() OVER (PARTITION BY b.city ORDER BY md5(strftime(ds, '%Y-%m-%d %H:%M:%S')), ds) AS r
  FROM base b JOIN guard g USING (city) WHERE g.error IS NULL) WHERE r <= recent_n),
sides AS (SELECT city, aqi, 1 AS side FROM sample UNION ALL
 SELECT city, r.aqi, 2 FROM {recent} r JOIN guard g USING (city) WHERE g.error IS NULL),
counts AS (SELECT city, aqi, count(*) FILTER (WHERE side = 1) AS c1, count(*) FILTER (WHERE side = 2) AS c2 FROM sides GROUP BY ALL),
cumul AS (SELECT city, sum(c1) OVER (PARTITION BY city ORDER BY aqi) AS u1, sum(c2) OVER (PARTITION BY city ORDER BY aqi) AS u2,
  sum(c1) OVER (PARTITION BY city) AS n1, sum(c2) OVER (PARTITION BY city) AS n2 FROM counts),
ks AS (SELECT city, max(n1)::BIGINT AS n1, max(n2)::BIGINT AS n2, max(abs(u1*n2 - u2*n1))::BIGINT AS gap FROM cumul GROUP BY city),
p AS (SELECT city, gap::DOUBLE/(n1*n2)::DOUBLE AS ks_stat, CASE WHEN gap = 0 THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE,
   2*list_sum(list_transform(range(1, n1 // (gap // n1) + 1), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END)
    * list_product(list_transform(range(0, k*(gap // n1)), lambda j: (n1 - j)::DOUBLE/(n1 + 1 + j)::DOUBLE))))) END AS p_value FROM ks)
SELECT city, round(coalesce(p_value, 1.0), 9) AS p_value, round(coalesce(ks_stat, 0.0), 9) AS ks_stat,
 coalesce(p_value < 0.05, false) AS is_drifted, CASE WHEN error IS NULL THEN round(baseline_mean, 9) END AS baseline_mean,
 CASE WHEN error IS NULL THEN round(recent_mean, 9) END AS recent_mean, CASE WHEN error IS NULL THEN recent_n ELSE 0 END::INTEGER AS recent_n,
 '{kind}' AS baseline_type, TIMESTAMP '{AS_OF}' AS checked_at, error
FROM guard LEFT JOIN p USING (city)"""


ANNUAL = "SELECT city, ts AS ds, aqi::DOUBLE AS aqi FROM hourly"
SEASONAL = ("SELECT city, ts AS ds, aqi::DOUBLE AS aqi FROM (SELECT *, count(*) FILTER (WHERE month(ts) = 1)"
            " OVER (PARTITION BY city) AS nm FROM hourly) WHERE nm < 100 OR month(ts) = 1")


def _raw(spark, sf):
    from hourgrid.functions.index import pm25_to_aqi

    return readings(spark, sf).select("city", "ts", pm25_to_aqi(F.col("pm25")).alias("aqi"))


def _inputs(spark, sf):
    """Features as a table, and the series in it."""
    features = saved(_features(spark, sf), "features")
    return features, features.select("city").distinct()


DRIFT_NUMBERS = ["p_value", "ks_stat", "baseline_mean", "recent_mean"]


@query("ks_drift", with_ctes(HOURLY_CTE, RECENT_SQL) + "," + _drift_sql(ANNUAL, "annual"))
def ks_drift(spark, sf):
    features, series = _inputs(spark, sf)
    out = drift.drift_report(features, _raw(spark, sf), series, KEYS, "ts", "aqi", AS_OF)
    return _rounded(out, DRIFT_NUMBERS)


@query("ks_drift_seasonal", with_ctes(HOURLY_CTE, RECENT_SQL) + "," + _drift_sql(SEASONAL, "seasonal"))
def _(spark, sf):
    features, series = _inputs(spark, sf)
    out = drift.drift_report(features, _raw(spark, sf), series, KEYS, "ts", "aqi", AS_OF, seasonal=True)
    return _rounded(out, DRIFT_NUMBERS)


GUARD_RECENT = ("recent2 AS (SELECT * FROM recent WHERE city <> 'click' AND (city <> 'view' OR ts >= TIMESTAMP '2024-01-30 00:00:00'))")
GUARD_BASE = ANNUAL + " WHERE city <> 'error'"


def _guarded(spark, sf):
    """One series without a baseline, one without recent rows, one with too few."""
    moment = F.lit(AS_OF).cast("timestamp_ntz")
    features, series = _inputs(spark, sf)
    base = baseline.baseline_for(features.filter("city <> 'error'"), KEYS, None)
    recent = drift.recent_hourly(_raw(spark, sf), KEYS, "ts", "aqi", moment).filter(
        (F.col("city") != "click")
        & ((F.col("city") != "view") | (F.col("ts") >= F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"))))
    return drift.check_drift(base, recent, series, KEYS, "annual", moment)


@query("drift_guardrails", with_ctes(HOURLY_CTE, RECENT_SQL, GUARD_RECENT) + "," + _drift_sql(GUARD_BASE, "annual", "recent2"))
def _(spark, sf):
    return _rounded(_guarded(spark, sf), DRIFT_NUMBERS)


def _shifted(spark, sf):
    """Recent indices raised by 40 for two cities, so that some series drift."""
    rows = _raw(spark, sf)
    shift = F.when(F.col("city").isin("click", "view"), 40).otherwise(0)
    return rows.withColumn("aqi", F.col("aqi") + shift)


@query("retrain_list", with_ctes(HOURLY_CTE, RECENT_SQL, "recent3 AS (SELECT city, ts, aqi + CASE WHEN city IN ('click', 'view') THEN 40 ELSE 0 END AS aqi FROM recent)")
       + "," + "result AS (WITH " + _drift_sql(ANNUAL, "annual", "recent3").strip() + ") SELECT city, recent_n, is_drifted FROM result WHERE is_drifted AND error IS NULL")
def _(spark, sf):
    features, series = _inputs(spark, sf)
    out = drift.drift_report(features, _shifted(spark, sf), series, KEYS, "ts", "aqi", AS_OF)
    return drift.retrain_list(out).select("city", "recent_n", "is_drifted")
