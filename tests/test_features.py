"""Windows, grid and fills against pandas on gappy series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourgrid.dimensions import LAG_HOURS, ROLLING_WINDOWS
from hourgrid.operators.dedupe import first_wins, upsert_first_wins
from hourgrid.operators.features import feature_table, with_series_windows
from hourgrid.operators.grid import directional_fill, grid_gaps, hourly_grid
from hourgrid.operators.quality import wind_unit_fix


def series(seed, start, hours, keep, last_at=None):
    """A random series with gaps; ``last_at`` adds one more row at that time."""
    rng = np.random.default_rng(seed)
    ts = pd.date_range(start, periods=hours, freq="h")
    ts = ts[rng.random(hours) < keep]
    if last_at is not None:
        ts = ts[ts < pd.Timestamp(last_at)].append(pd.DatetimeIndex([last_at]))
    return pd.Series(rng.integers(0, 500, len(ts)).astype(float), index=ts)


CASES = {
    "dense": series(1, "2024-01-01 05:00", 24 * 40, 0.97),
    "sparse": series(2, "2024-01-03 00:00", 24 * 50, 0.15),
    "midnight": series(3, "2024-02-01 11:00", 24 * 12, 0.6, "2024-02-10 00:00"),
    "single": series(4, "2024-03-01 07:00", 1, 1.0),
}


def expected(s, include_current=True):
    grid = pd.date_range(s.index.min().floor("D"), s.index.max().ceil("D") - pd.Timedelta(hours=1), freq="h")
    g = s.reindex(grid)
    out = pd.DataFrame({"aqi": g})
    for h in LAG_HOURS:
        out[f"aqi_lag_{h}h"] = g.shift(h).bfill().fillna(g.mean())
    base = g if include_current else g.shift(1)
    for h, name in ROLLING_WINDOWS:
        rolling = base.rolling(h, min_periods=1)
        for stat in ("mean", "std", "max"):
            out[f"aqi_roll_{stat}_{name}"] = getattr(rolling, stat)().fillna(g.mean())
    return out.dropna(subset=["aqi"])


@pytest.fixture(scope="module")
def hourly(spark):
    pdf = pd.concat([pd.DataFrame({"city": k, "ts": s.index, "aqi": s.values}) for k, s in CASES.items()])
    return spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz")).cache()


@pytest.mark.parametrize("include_current", [True, False])
@pytest.mark.parametrize("bucket_hours", [168, 720])
def test_windows_equal_pandas(hourly, include_current, bucket_hours):
    got = with_series_windows(hourly, ["city"], "ts", "aqi", include_current=include_current,
                              bucket_hours=bucket_hours).toPandas()
    for city, s in CASES.items():
        want = expected(s, include_current)
        have = got[got.city == city].set_index("ts").sort_index()[want.columns]
        assert list(have.index) == list(want.index)
        np.testing.assert_allclose(have.to_numpy(), want.to_numpy(), rtol=1e-9, atol=1e-9)


def test_bucket_must_hold_the_halo(hourly):
    with pytest.raises(ValueError):
        with_series_windows(hourly, ["city"], "ts", "aqi", bucket_hours=24)


def test_lag_equals_self_join_where_present(hourly):
    got = with_series_windows(hourly, ["city"], "ts", "aqi", lags=[24], windows=())
    before = hourly.select("city", (F.col("ts") + F.expr("INTERVAL 24 HOURS")).alias("ts"), F.col("aqi").alias("b"))
    assert got.join(before, ["city", "ts"]).filter("b <> aqi_lag_24h").count() == 0


def test_grid(hourly):
    grid = hourly_grid(hourly, ["city"]).toPandas()
    for city, s in CASES.items():
        want = pd.date_range(s.index.min().floor("D"), s.index.max().ceil("D") - pd.Timedelta(hours=1), freq="h")
        have = grid[grid.city == city].sort_values("ts")
        assert list(have.ts) == list(want)
        assert (have.groupby(have.ts.dt.date).size() == 24).all()
    gaps = {r.city: r for r in grid_gaps(hourly, ["city"], "ts", "aqi").collect()}
    assert all(gaps[c].missing_hours == grid[grid.city == c].aqi.isna().sum() for c in CASES)


def test_grid_keeps_the_closing_midnight_on_request(hourly):
    plain, kept = (hourly_grid(hourly.filter("city = 'midnight'"), ["city"], keep_last=k) for k in (False, True))
    assert plain.agg(F.max("ts")).first()[0] == pd.Timestamp("2024-02-09 23:00")
    assert kept.agg(F.max("ts")).first()[0] == pd.Timestamp("2024-02-10 23:00")
    assert kept.filter("aqi IS NOT NULL").count() == plain.filter("aqi IS NOT NULL").count() + 1


@pytest.mark.parametrize("bucket_hours", [24, 100, 10_000])
@pytest.mark.parametrize("backward", [True, False])
def test_directional_fill(hourly, backward, bucket_hours):
    grid = hourly_grid(hourly, ["city"])
    got = directional_fill(grid, ["city"], "ts", "aqi", "f", backward, bucket_hours).toPandas()
    for city in CASES:
        part = got[got.city == city].sort_values("ts")
        want = part.aqi.bfill() if backward else part.aqi.ffill()
        np.testing.assert_array_equal(part.f.to_numpy(), want.to_numpy())


def test_feature_table(hourly, spark):
    rng = np.random.default_rng(7)
    wx = [(c, str(t), float(v), 60.0) for c, s in CASES.items()
          for t, v in zip(s.index[::2], rng.normal(20, 5, len(s)))]
    weather = spark.createDataFrame(wx, "city string, ts string, temperature_2m double, wind_speed_10m double")
    weather = wind_unit_fix(weather.withColumn("ts", F.col("ts").cast("timestamp_ntz")), ["city"])
    got = feature_table(hourly, ["city"], weather=weather).toPandas()
    frame = pd.DataFrame(wx, columns=["city", "ts", "t", "w"])
    for city, s in CASES.items():
        want = expected(s)
        have = got[got.city == city].set_index("ds").sort_index()
        assert list(have.index) == list(want.index)
        part = frame[frame.city == city].set_index("ts").t
        part.index = pd.to_datetime(part.index)
        grid = pd.date_range(s.index.min().floor("D"), s.index.max().ceil("D") - pd.Timedelta(hours=1), freq="h")
        filled = part.reindex(grid)
        filled = filled.fillna(filled.mean()).reindex(want.index)
        np.testing.assert_allclose(have.temperature_2m.to_numpy(float), filled.to_numpy())
        np.testing.assert_allclose(have.wind_speed_10m.to_numpy(float), 60 / 3.6)
    no_weather = feature_table(hourly, ["city"])
    assert no_weather.filter("temperature_2m IS NOT NULL").count() == 0
    assert no_weather.count() == len(got)


def test_first_wins_prefers_values(spark):
    df = spark.createDataFrame([("a", 1, None, "x"), ("a", 1, 21.5, None), ("b", None, 3.0, "y"), ("b", 2, 4.0, "z")],
                               "city string, seq int, v double, w string")
    got = {r.city: r.v for r in first_wins(df, ["city"], [F.col("seq")]).collect()}
    assert got == {"a": 21.5, "b": 4.0}


def test_first_wins_and_upsert(rows):
    data = [("a", "2024-01-01 00:00:00", 2, 20.0), ("a", "2024-01-01 00:00:00", 1, 10.0), ("b", "2024-01-01 00:00:00", 3, 30.0)]
    schema = "city string, ts string, seq int, v double"
    old = rows(data, schema, ["ts"])
    assert sorted((r.city, r.v) for r in first_wins(old, ["city", "ts"], [F.col("seq")]).collect()) == [("a", 10.0), ("b", 30.0)]
    new = rows([("a", "2024-01-01 00:00:00", 0, 99.0), ("a", "2024-01-01 01:00:00", 5, 50.0)], schema, ["ts"])
    merged = upsert_first_wins(old, new.withColumn("extra", F.lit(1)), ["city", "ts"], [F.col("seq")])
    assert sorted((r.city, r.ts.hour, r.v, r.extra) for r in merged.collect()) == [
        ("a", 0, 10.0, None), ("a", 1, 50.0, 1), ("b", 0, 30.0, None)]
    again = upsert_first_wins(merged, new.withColumn("extra", F.lit(1)), ["city", "ts"], [F.col("seq")])
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))
