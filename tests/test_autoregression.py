"""The autoregressive baseline: known coefficients, a plain fit with gaps, plain forecasts, odd series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid.operators import autoregression as ar
from hourgrid.plans import lifecycle as life

SMALL = ar.Orders(season=4, long=6, own=(1,), shocks=(1,), gap=0)


def simulated(n, own, shock, season, seed):
    rng = np.random.default_rng(seed)
    e, w, y = rng.normal(0, 1, n), np.zeros(n), np.zeros(n)
    for t in range(season + 1, n):
        w[t] = own * w[t - 1] + shock * e[t - 1] + e[t]
        y[t] = w[t] + y[t - 1] + y[t - season] - y[t - season - 1]
    return y


def frame(spark, series):
    rows = [(k, int(t), float(v)) for k, y in series.items() for t, v in enumerate(y) if np.isfinite(v)]
    df = spark.createDataFrame(rows, "city string, t long, y double")
    return df.withColumn("ds", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, t)")).drop("t")


def plain(y, orders):
    """Both stages over the whole series at once, from the definition."""
    n, s = len(y), orders.season
    w = [y[t] - y[t - 1] - y[t - s] + y[t - s - 1] if t > s else np.nan for t in range(n)]

    def stage(columns):
        rows = [(r, w[t]) for t in range(n) if np.isfinite(r := columns(t)).all() and np.isfinite(w[t])]
        x, z = np.array([r for r, _ in rows]), np.array([v for _, v in rows])
        b = np.linalg.lstsq(x, z, rcond=None)[0]
        return b, np.sqrt(np.mean((z - x @ b) ** 2)), len(rows)

    def at(a, t):
        return a[t] if t >= 0 else np.nan

    long = stage(lambda t: np.array([at(w, t - k) for k in range(1, orders.long + 1)]))[0]
    e = [w[t] - sum(long[k - 1] * at(w, t - k) for k in range(1, orders.long + 1)) for t in range(n)]
    return long, *stage(lambda t: np.array([at(w, t - k) for k in orders.own] + [at(e, t - k) for k in orders.shocks]))


def test_known_coefficients_and_plain_fit(spark):
    gappy = simulated(3000, 0.3, 0.4, 4, 2)
    gappy[np.random.default_rng(3).integers(0, 3000, 120)] = np.nan
    series = {"a": simulated(6000, 0.6, -0.4, 4, 1), "b": gappy}
    got = {r.city: r for r in ar.fit(frame(spark, series), ["city"], orders=SMALL, bucket_hours=100).collect()}
    assert got["a"].coefficients == pytest.approx([0.6, -0.4], abs=0.05) and got["a"].sigma == pytest.approx(1, abs=0.03)
    for city, y in series.items():
        long, beta, sigma, rows = plain(y, SMALL)
        assert got[city].rows == rows
        assert got[city].long == pytest.approx(long, abs=1e-6) and got[city].coefficients == pytest.approx(beta, abs=1e-6)
        assert got[city].sigma == pytest.approx(sigma, abs=1e-6)


def test_season_of_shocks(spark):
    orders = ar.Orders(season=4, long=20, own=(1, 4), shocks=(1, 4))
    y = simulated(4000, 0.5, 0.3, 4, 5)
    got = ar.fit(frame(spark, {"a": y}), ["city"], orders=orders).first()
    assert got.coefficients == pytest.approx(plain(y, orders)[1], abs=1e-6)


def test_short_gaps_take_the_value_before(spark):
    orders = ar.Orders(season=4, long=6, own=(1,), shocks=(1,), gap=2)
    y = simulated(1500, 0.4, 0.2, 4, 9)
    y[np.random.default_rng(4).integers(1, 1500, 150)] = np.nan
    y[700:707] = np.nan
    df = frame(spark, {"a": y})
    small, whole = (ar.fit(df, ["city"], orders=orders, bucket_hours=b).first() for b in (60, 5000))
    assert small.rows == whole.rows > 1200 and small.coefficients == pytest.approx(whole.coefficients, abs=1e-9)


def test_forecast_by_hand(spark):
    y = 200 + simulated(800, 0.6, -0.4, 4, 7) * 0.01
    df = frame(spark, {"a": y})
    fitted = ar.fit(df, ["city"], orders=SMALL)
    long, beta, sigma, _ = plain(y, SMALL)
    got = ar.predict(df, fitted, ["city"], 6, orders=SMALL).orderBy("ds").collect()
    w = [y[t] - y[t - 1] - y[t - 4] + y[t - 5] if t > 4 else 0.0 for t in range(len(y))]
    e_last = w[-1] - sum(long[k - 1] * w[-1 - k] for k in range(1, 7))
    path, w_now, e_now = list(y), w[-1], e_last
    for r in got:
        w_now, e_now = beta[0] * w_now + beta[1] * e_now, 0.0
        path.append(w_now + path[-1] + path[-4] - path[-5])
        assert r.yhat == pytest.approx(path[-1], abs=1e-6)
    widths = [(r.yhat_upper - r.yhat) / 1.959963984540054 for r in got]
    # the first band is one shock wide, the second has the shock's reply too
    assert widths[0] == pytest.approx(sigma, abs=1e-6)
    assert widths[1] == pytest.approx(sigma * np.sqrt(1 + (1 + beta[0] + beta[1]) ** 2), abs=1e-6)
    assert str(got[0].ds) == "2024-02-03 08:00:00" and len(got) == 6


def test_odd_series(spark):
    nan = float("nan")
    df = frame(spark, {"short": [5.0, 6.0, 7.0], "one": [9.0], "flat": [3.0] * 300}).unionByName(
        spark.sql("SELECT 'none' AS city, CAST(NULL AS DOUBLE) AS y, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ds")).unionByName(
        spark.createDataFrame([("flat", nan)], "city string, y double").withColumn("ds", F.expr("TIMESTAMP_NTZ'2030-01-01 00:00:00'")))
    fitted = ar.fit(df, ["city"], orders=SMALL)
    got = {r.city: r for r in fitted.collect()}
    assert set(got) == {"short", "one", "flat"} and got["one"].coefficients == [0.0, 0.0] and got["short"].rows == 0
    ahead = {}
    for r in ar.predict(df, fitted, ["city"], 3, orders=SMALL).orderBy("ds").collect():
        ahead.setdefault(r.city, []).append(r.yhat)
    assert ahead["one"] == [9.0] * 3 and ahead["flat"] == pytest.approx([3.0] * 3)
    assert ar.fit(df.limit(0), ["city"], orders=SMALL).count() == 0


def test_baselines_beside_champions(spark, tmp_path):
    """A series that repeats every day on a slope: both baselines know the day, only one the slope."""
    at = life.Layout(str(tmp_path))
    t = np.arange(24 * 40)
    wave = 100 + 30 * np.sin(t * 2 * np.pi / 24) + 0.1 * t + np.random.default_rng(1).normal(0, 0.1, len(t))
    frame(spark, {"a": wave, "b": wave + 20}).write.parquet(at.features)
    got = {(r.city, r.baseline): r for r in life.score_baselines(spark, at).collect()}
    assert set(got) == {(c, b) for c in "ab" for b in ("autoregressive", "seasonal_naive")}
    assert got["a", "autoregressive"].mae < 2 < got["a", "seasonal_naive"].mae < 3 and got["a", "autoregressive"].improvement_pct is None
    spark.sql("SELECT 'a' AS city, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS trained_at, 1.2D AS mae").write.parquet(f"{at.versions}/version=1")
    again = {(r.city, r.baseline): r for r in life.score_baselines(spark, at).collect()}
    naive = again["a", "seasonal_naive"]
    assert naive.improvement_pct == pytest.approx((naive.mae - 1.2) / naive.mae * 100) and again["b", "seasonal_naive"].model_mae is None
