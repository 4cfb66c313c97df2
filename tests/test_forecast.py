"""Forecasts, metrics, calibration, promotion."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid.operators import forecast, metrics, registry, regression

HOURS = "explode(sequence(TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-01 00:00:00' + INTERVAL {} HOURS, INTERVAL 1 HOUR))"


def label(v):
    v = int(v)
    for low, high, name in ((0, 50, "Good"), (51, 100, "Satisfactory"), (101, 200, "Moderate"), (201, 300, "Poor"), (301, 400, "Very Poor")):
        if low <= v <= high:
            return name
    return "Severe"


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    df = spark.sql(f"SELECT {HOURS.format(599)} AS ds").toPandas()
    df["city"] = np.where(np.arange(600) < 450, "a", "b")
    df["y"] = rng.integers(0, 450, 600).astype(float)
    df["yhat"] = np.clip(df.y + rng.normal(0, 30, 600), 0, 500)
    width = rng.integers(5, 60, 600)
    df["yhat_lower"], df["yhat_upper"] = df.yhat - width, df.yhat + width
    return df


def test_evaluate_and_bins_equal_numpy(spark, scored):
    sdf = spark.createDataFrame(scored).withColumn("ds", F.col("ds").cast("timestamp_ntz"))
    got = {r.city: r for r in metrics.evaluation_report(sdf, ["city"]).collect()}
    for city, part in scored.groupby("city"):
        y, p, lo, hi = (part[c].to_numpy() for c in ("y", "yhat", "yhat_lower", "yhat_upper"))
        same = np.array([label(a) == label(b) for a, b in zip(y, p)])
        near = np.min(np.abs(y[:, None] - np.array([50, 100, 200, 300, 400])), axis=1) <= 10
        covered = (y >= lo) & (y <= hi)
        rush = part.ds.dt.hour.isin([7, 8, 9, 10, 17, 18, 19, 20]).to_numpy()
        r = got[city]
        for name, want in {
            "mae": np.abs(y - p).mean(), "rmse": np.sqrt(((y - p) ** 2).mean()),
            "mape_clip": (np.abs(y - p) / np.clip(np.abs(y), 1, None)).mean() * 100,
            "mape_eps": np.abs((y - p) / (y + 1e-8)).mean() * 100,
            "coverage_95": covered.mean() * 100, "category_accuracy": same.mean() * 100,
            "boundary_error_rate": (~same & near).mean() * 100,
            "category_accuracy_ex_boundary": same[~near].mean() * 100,
            "coverage_95_ex_boundary": covered[~near].mean() * 100,
            "rush_hour_mae": np.abs(y - p)[rush].mean(), "calibration_gap": max(0, 95 - covered.mean() * 100),
            "boundary_share_of_errors": (~same & near).mean() / (1 - same.mean()),
        }.items():
            assert r[name] == pytest.approx(want), name
        w = hi - lo
        edges = np.quantile(w, np.linspace(0, 1, 6))
        assert [b.bin for b in r.calibration_bins] == [1, 2, 3, 4, 5]
        for i, b in enumerate(r.calibration_bins):
            inside = (w >= edges[i]) & ((w < edges[i + 1]) if i < 4 else (w <= edges[i + 1]))
            assert b["count"] == inside.sum()
            assert (b.coverage is None) if not inside.any() else b.coverage == pytest.approx(covered[inside].mean() * 100)


def test_equal_widths_leave_empty_bins(spark):
    df = spark.createDataFrame([("c", float(i), 0.0, 10.0) for i in range(20)], "city string, y double, yhat_lower double, yhat_upper double")
    got = metrics.calibration_bins(df, ["city"]).orderBy("bin").collect()
    assert [(r["count"], r.coverage) for r in got] == [(0, None)] * 4 + [(20, pytest.approx(55.0))]


def test_no_errors_and_no_rush_hours(spark):
    df = spark.createDataFrame([("c", 10.0, 10.0, 5.0, 15.0)], "city string, y double, yhat double, yhat_lower double, yhat_upper double")
    r = metrics.evaluate(df.withColumn("ds", F.expr("TIMESTAMP_NTZ'2024-01-01 02:00:00'")), ["city"]).first()
    assert r.boundary_share_of_errors == 0.0 and r.rush_hour_mae is None and r.coverage_95 == 100.0


def test_split_by_time(spark):
    df = spark.sql(f"SELECT 'c' AS city, {HOURS.format(24 * 10)} AS ds").withColumn("y", F.lit(1.0))
    got = {r.split: r["count"] for r in metrics.split_by_time(df, ["city"], test_days=7).groupBy("split").count().collect()}
    assert got == {"test": 168, "train": 73}
    short = metrics.split_by_time(df, ["city"], test_days=7, min_test_rows=500).select("split").distinct().collect()
    assert [r.split for r in short] == ["short"]


def test_seasonal_naive(spark):
    df = spark.sql(f"SELECT 'c' AS city, {HOURS.format(24 * 21 - 1)} AS ds").withColumn(
        "y", (F.hour("ds") * 10 + F.weekday("ds")).cast("double"))
    df = metrics.split_by_time(df.filter("ds <> TIMESTAMP_NTZ'2024-01-20 05:00:00'"), ["city"])
    got = {r.ds.isoformat(): r for r in forecast.seasonal_naive(df, ["city"]).collect()}
    assert len(got) == 24 * 21 - 1
    assert got["2024-01-20T06:00:00"].yhat == 64.0  # Friday's value of that hour
    assert got["2024-01-21T05:00:00"].yhat == 56.0  # no value a day ago: Sundays at five
    assert got["2024-01-01T03:00:00"].yhat == 30.0  # start of the series: the same fallback
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper and 0 <= r.yhat <= 500 for r in got.values())


@pytest.fixture(scope="module")
def trained(spark):
    model = regression.SeasonalModel(seasonalities=((1.0, 3), (7.0, 2)), changepoints=4, regressors=("temperature_2m",))
    df = spark.sql(f"SELECT explode(array('a', 'b')) AS city, ds FROM (SELECT {HOURS.format(24 * 28 - 1)} AS ds)")
    noise = (F.xxhash64("city", "ds") % 1000) / 100.0
    df = df.withColumn("temperature_2m", (F.xxhash64("ds") % 100) / 10.0).withColumn(
        "y", 150 + 40 * F.sin(F.hour("ds") * 0.2618) + 2 * F.col("temperature_2m") + F.when(F.col("city") == "a", 60).otherwise(0) + noise)
    return model, metrics.split_by_time(df.repartition(5), ["city"], test_days=7)


def test_fit_equals_normal_equations(spark, trained):
    model, df = trained
    train = df.filter("split = 'train'")
    fitted = {r.city: r for r in regression.fit(train, ["city"], model=model).collect()}
    assert set(fitted) == {"a", "b"} and regression.SeasonalModel.of_shape(fitted["a"].shape).shape() == model.shape()
    other = regression.SeasonalModel(seasonalities=model.seasonalities, changepoints=model.changepoints, regressors=())
    with pytest.raises(Exception, match="another shape"):
        regression.predict(df, regression.fit(train, ["city"], model=model), ["city"], model=other).collect()
    pdf = train.toPandas()
    for city, part in pdf.groupby("city"):
        sec = part.ds.astype("datetime64[s]").astype("int64").to_numpy().astype(float)
        t = (sec - sec.min()) / (sec.max() - sec.min())
        cols = [np.ones_like(t), t] + [np.maximum(0, t - 0.8 * i / 4) for i in range(1, 5)]
        for period, order in model.seasonalities:
            for k in range(1, order + 1):
                angle = sec / 86400 * 2 * np.pi * k / period
                cols += [np.sin(angle), np.cos(angle)]
        temp = part.temperature_2m.to_numpy()
        cols.append((temp - temp.mean()) / temp.std())
        x, scale = np.column_stack(cols), np.abs(part.y).max()
        want = np.linalg.solve(x.T @ x + np.diag(model.penalties()), x.T @ (part.y.to_numpy() / scale))
        np.testing.assert_allclose(fitted[city].coefficients, want, rtol=1e-6, atol=1e-8)
        rss = np.sqrt(((part.y / scale - x @ want) ** 2).mean())
        assert fitted[city].sigma == pytest.approx(rss, rel=1e-6)


def test_predict_beats_the_mean_and_orders_bounds(trained):
    model, df = trained
    fitted = regression.fit(df.filter("split = 'train'"), ["city"], model=model)
    got = regression.predict(df.filter("split = 'test'"), fitted, ["city"], model=model).toPandas()
    assert len(got) == 2 * 168
    assert ((got.yhat_lower <= got.yhat) & (got.yhat <= got.yhat_upper)).all() and got.yhat.between(0, 500).all()
    assert (got.y - got.yhat).abs().mean() < 0.5 * (got.y - got.y.mean()).abs().mean()
    covered = ((got.y >= got.yhat_lower) & (got.y <= got.yhat_upper)).mean()
    assert covered > 0.85


def test_future_frame_fallbacks(spark):
    as_of = F.lit("2024-10-05 06:20:00").cast("timestamp_ntz")
    series = spark.createDataFrame([("a",), ("b",)], "city string")
    weather = spark.createDataFrame([("a", "2024-10-05 07:00:00", 30.0)], "city string, ts string, temperature_2m double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    means = spark.createDataFrame([("a", 25.0)], "city string, temperature_2m double")
    current = spark.createDataFrame([("a", 180.0)], "city string, value double")
    rows = forecast.future_frame(series, ["city"], as_of, 3, weather, means, current, None).orderBy("city", "ds").collect()
    assert [(r.city, r.ds.hour, r.temperature_2m, r.aqi_lag_24h, r.aqi_roll_mean_24h, r.is_rush_hour, r.wind_speed_10m) for r in rows] == [
        ("a", 6, 25.0, 180.0, 100.0, 0, 0.0), ("a", 7, 30.0, 180.0, 100.0, 1, 0.0), ("a", 8, 25.0, 180.0, 100.0, 1, 0.0),
        ("b", 6, 0.0, 100.0, 100.0, 0, 0.0), ("b", 7, 0.0, 100.0, 100.0, 1, 0.0), ("b", 8, 0.0, 100.0, 100.0, 1, 0.0)]
    assert {(r.crop_burning, r.festival_period, r.temp_inversion) for r in rows} == {(1.0, 0.55, 0.0)}


@pytest.mark.parametrize("horizon", [0, 49])
def test_horizon_is_checked(spark, horizon):
    with pytest.raises(ValueError):
        forecast.future_hours(spark.createDataFrame([("a",)], "city string"), ["city"], F.lit("2024-01-01").cast("timestamp_ntz"), horizon)


def test_output_and_headline(spark):
    df = spark.sql(f"SELECT 'c' AS city, {HOURS.format(7)} AS ds").withColumns({
        "yhat": F.hour("ds") * 100.0 + 0.5, "yhat_lower": F.lit(-5.0), "yhat_upper": F.lit(900.0)})
    out = forecast.forecast_output(df, ["city"]).orderBy("timestamp").collect()
    assert [r.aqi for r in out] == [0, 100, 200, 300, 400, 500, 500, 500]
    assert (out[1].timestamp, out[1].timestamp_ist, out[1].aqi_lower, out[1].aqi_upper, out[1].category.label) == (
        "2024-01-01T01:00:00", "2024-01-01T06:30:00+05:30", 0, 500, "Satisfactory")
    head = forecast.forecast_headline(df.select("city", "ds", F.hour("ds").alias("aqi")), ["city"], "ds", "aqi").first()
    assert (head.next_6h_avg, head.peak, head.low) == (2.5, 7, 0)


def test_promotion(spark):
    versions = spark.createDataFrame([("a", 1, 30.0), ("a", 2, 31.0), ("a", 3, 25.0), ("a", 4, 25.0), ("b", 1, 9.0)], "city string, version int, mae double")
    history = registry.champion_history(versions, ["city"])
    got = {(r.city, r.version): (r.status, r.promoted) for r in history.collect()}
    assert got == {("a", 1): ("retired", True), ("a", 2): ("challenger", False), ("a", 3): ("champion", True),
                   ("a", 4): ("challenger", False), ("b", 1): ("champion", True)}
    series = spark.createDataFrame([("a",), ("b",), ("c",)], "city string")
    found = {r.city: (r.version, r.mae, r.loaded) for r in registry.champion_lookup(series, history, ["city"]).collect()}
    assert found == {"a": (3, 25.0, True), "b": (1, 9.0, True), "c": (None, float("inf"), False)}
    assert [r.city for r in registry.missing_champions(series, history, ["city"]).collect()] == ["c"]


def test_orthogonal_columns_are_soft_thresholded():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(200, 12)))[0] * 3
    y = q @ rng.normal(size=12) + rng.normal(size=200)
    weights = np.full(12, 4.0)
    got = regression.solve_penalised(q.T @ q, q.T @ y, np.zeros(12), weights)
    pull = q.T @ y
    np.testing.assert_allclose(got, np.sign(pull) * np.maximum(np.abs(pull) - 4.0, 0) / 9, atol=1e-12)
    assert 0 < (got == 0).sum() < 12


@pytest.mark.parametrize("weight", [0.01, 1.0, 30.0, 1e6])
def test_sparse_changes_meet_the_conditions_of_the_minimum(weight):
    """Hinge columns are nearly collinear: gradient within the weight where zero, equal to it elsewhere."""
    rng = np.random.default_rng(3)
    t = np.linspace(0, 1, 2000)
    knots = 0.8 * np.arange(1, 26) / 25
    x = np.column_stack([np.ones_like(t), t, np.maximum(0, t[:, None] - knots), np.sin(40 * t), np.cos(40 * t)])
    y = 0.3 * t + 2 * np.maximum(0, t - knots[9]) - 3 * np.maximum(0, t - knots[17]) + 0.1 * np.sin(40 * t) + rng.normal(0, 0.05, len(t))
    ridge = np.concatenate([np.zeros(27), np.full(2, 0.01)])
    absolute = np.concatenate([np.zeros(2), np.full(25, weight), np.zeros(2)])
    beta = regression.solve_penalised(x.T @ x, x.T @ y, ridge, absolute)
    gradient = x.T @ (y - x @ beta) - ridge * beta
    free = absolute == 0
    np.testing.assert_allclose(gradient[free], 0, atol=1e-6)
    on = ~free & (beta != 0)
    np.testing.assert_allclose(gradient[on], weight * np.sign(beta[on]), rtol=1e-4, atol=1e-4)
    assert (np.abs(gradient[~free]) <= weight * (1 + 1e-4) + 1e-4).all()
    assert (on.sum() >= 2) == (weight <= 1.0)


def test_laplace_fit_is_sparse_and_follows_the_trend(spark):
    rows = spark.range(900).selectExpr("'c' AS city", "timestamp_ntz'2022-01-01 00:00:00' + make_dt_interval(cast(id AS int)) AS ds",
                                       "100 + 0.1D * id + if(id > 360, 0.5D * (id - 360), 0D) + 20 * (rand(5) - 0.5) AS y")
    model = regression.SeasonalModel(seasonalities=(), changepoint_shape="laplace", regressors=())
    fitted = regression.fit(rows, ["city"], model=model)
    changes = np.array(fitted.first().coefficients[2:])
    assert 1 <= (np.abs(changes) > 1e-9).sum() < 13
    ridge = np.array(regression.fit(rows, ["city"], model=regression.SeasonalModel(seasonalities=(), regressors=())).first().coefficients[2:])
    assert (np.abs(ridge) > 1e-9).sum() == 25
    scored = regression.predict(rows, fitted, ["city"], model=model).selectExpr("max(abs(least(y, 500) - yhat)) AS e").first()
    assert scored.e < 25
