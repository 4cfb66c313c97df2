"""KS statistic, exact p-values, guards and quantiles."""

import random
import struct
import time
from itertools import combinations
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid.operators import drift
from hourgrid.operators.baseline import baseline_for, baseline_stats, month_counts
from hourgrid.operators import quantiles
from hourgrid.operators.quantiles import day_sketches, exact_quantiles, merged_quantiles, ordered_bits


def ks(spark, a, b):
    sides = spark.createDataFrame([("s", float(x), 1) for x in a] + [("s", float(x), 2) for x in b],
                                  "city string, v double, side int")
    return drift.with_p_value(drift.ks_statistic(sides, ["city"], "v", "side")).first()


def brute_d(a, b):
    points = np.concatenate([a, b])
    return max(abs(np.mean(a <= x) - np.mean(b <= x)) for x in points)


def brute_p(n1, n2, gap):
    """Share of all orderings of the pooled ranks whose distance is at least the given one."""
    hits = 0
    for first in combinations(range(n1 + n2), n1):
        i = j = worst = 0
        chosen = set(first)
        for k in range(n1 + n2):
            i, j = (i + 1, j) if k in chosen else (i, j + 1)
            worst = max(worst, abs(i * n2 - j * n1))
        hits += worst >= gap
    return hits / comb(n1 + n2, n1)


@pytest.mark.parametrize("n1, n2", [(5, 5), (6, 6), (4, 7), (7, 4), (3, 8)])
def test_p_value_equals_enumeration(spark, n1, n2):
    rng = np.random.default_rng(n1 * 10 + n2)
    for _ in range(3):
        a, b = rng.normal(0, 1, n1), rng.normal(0.7, 1, n2)
        got = ks(spark, a, b)
        assert got.ks_stat == pytest.approx(brute_d(a, b))
        assert got.p_value == pytest.approx(brute_p(n1, n2, got.gap), abs=1e-12)
        assert got.p_method == "exact"


def test_same_and_shifted_distributions(spark):
    rng = np.random.default_rng(42)
    base = rng.normal(150, 30, 100)
    same, shifted = ks(spark, base, rng.normal(150, 30, 100)), ks(spark, base, rng.normal(60, 15, 100))
    assert same.p_value > 0.05 and same.ks_stat < 0.3
    assert shifted.p_value < 0.05 and shifted.ks_stat > 0.3
    assert ks(spark, base, base).p_value == 1.0


def test_symmetric_and_invariant_to_monotone_maps(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(1, 60, 30), rng.integers(10, 70, 30)
    plain = ks(spark, a, b)
    for other in (ks(spark, b, a), ks(spark, np.exp(a / 10), np.exp(b / 10))):
        assert (other.ks_stat, other.p_value) == (plain.ks_stat, plain.p_value)


def sides(spark, n1, n2, shift):
    one, two = (spark.range(n).select(F.lit("s").alias("city"), ((F.col("id") % 500) + d).cast("double").alias("v"), F.lit(side).alias("side"))
                for n, d, side in ((n1, 0, 1), (n2, shift, 2)))
    return drift.ks_statistic(one.union(two), ["city"], "v", "side")


def test_method_is_the_callers(spark):
    """The limit distribution only where it is asked for, at any size."""
    for n in (50, 12_000):
        got = drift.with_p_value(sides(spark, n, n, 6), "asymptotic").first()
        lam = got.ks_stat * (n / 2) ** 0.5
        want = 1.0 if lam < 0.2 else 2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * lam * lam) for k in range(1, 101))
        assert got.p_method == "asymptotic" and got.p_value == pytest.approx(min(1, want), rel=1e-9)
    with pytest.raises(ValueError):
        drift.with_p_value(sides(spark, 5, 5, 1), "auto")


@pytest.mark.parametrize("n1,n2", [(20_000, 19_500), (20_000, 20_000)])
def test_large_samples_are_exact(spark, n1, n2):
    start = time.time()
    exact, limit = (drift.with_p_value(sides(spark, n1, n2, 6), m).first() for m in drift.P_METHODS)
    assert exact.p_method == "exact" and exact.p_value == pytest.approx(limit.p_value, rel=0.05)
    assert 1e-3 < exact.p_value < 0.5 and time.time() - start < 60


def hours(start, n):
    return f"SELECT explode(sequence(TIMESTAMP_NTZ'{start}', TIMESTAMP_NTZ'{start}' + INTERVAL {n - 1} HOURS, INTERVAL 1 HOUR)) AS ts"


def test_guards(spark):
    raw = spark.sql(hours("2024-01-30 00:00:00", 2)).selectExpr("'few' AS city", "ts", "120 AS aqi")
    series = spark.createDataFrame([("few",), ("none",)], "city string")
    features = spark.sql(hours("2024-01-01 00:00:00", 200)).selectExpr("'few' AS city", "ts AS ds", "100.0D AS y")
    got = {r.city: r for r in drift.drift_report(features, raw, series, ["city"], "ts", "aqi", "2024-01-31 00:00:00").collect()}
    assert got["few"].error == "Insufficient recent data: 2 samples (need 24)"
    assert got["none"].error == "Baseline not found"
    for r in got.values():
        assert (r.p_value, r.ks_stat, r.is_drifted, r.recent_n, r.baseline_mean) == (1.0, 0.0, False, 0, None)


def test_small_baseline_is_not_sampled_and_exact(spark):
    features = spark.sql(hours("2024-01-01 00:00:00", 30)).selectExpr("'c' AS city", "ts AS ds", "cast(hour(ts) AS double) AS y")
    raw = spark.sql(hours("2024-01-29 00:00:00", 40)).selectExpr("'c' AS city", "ts", "cast(hour(ts) + 15 AS int) AS aqi")
    series = spark.createDataFrame([("c",)], "city string")
    got = drift.drift_report(features, raw, series, ["city"], "ts", "aqi", "2024-01-31 00:00:00").first()
    assert got.recent_n == 40 and got.is_drifted and got.error is None and 0 < got.p_value < 0.05


def test_hash_sample_equals_one_ranking(spark):
    rows = spark.sql(hours("2020-01-01 00:00:00", 9000)).selectExpr("'c' AS city", "ts AS ds", "rand(3) AS aqi")
    sizes = spark.createDataFrame([("c", 168)], "city string, n int")
    got = drift.hash_sample(rows.repartition(7), sizes, ["city"], "ds", "n", 169).select("ds").collect()
    want = rows.orderBy(F.md5(F.date_format("ds", "yyyy-MM-dd HH:mm:ss")), "ds").limit(168).select("ds").collect()
    assert sorted(got) == sorted(want)


def test_monthly_baseline_falls_back(spark):
    df = spark.sql(hours("2024-01-01 00:00:00", 24 * 33)).selectExpr("'c' AS city", "ts AS ds", "1.0D AS y")
    assert baseline_for(df, ["city"], 1).count() == 24 * 31
    assert baseline_for(df, ["city"], 2).count() == 24 * 33
    assert {r.month: r.has_baseline for r in month_counts(df, ["city"]).collect()} == {1: True, 2: False}


def test_sample_reaches_its_key_as_few_rows_a_task(spark):
    """The limit stands below the exchange: a bottom-k in every task."""
    rows = spark.sql(hours("2020-01-01 00:00:00", 9000)).selectExpr("if(hour(ts) < 12, 'c', 'd') AS city", "ts AS ds", "1.0D AS aqi")
    plan = drift.baseline_sample(rows.repartition(7), ["city"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ordered_bits(spark):
    rng = random.Random(1)
    values = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values += [s * 2.0 ** e * f for e in range(-1021, 1024, 7) for f in (1, 1 - 2 ** -53, 1 + 2 ** -52) for s in (1, -1)]
    values += [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022 * (1 - 2 ** -52), float("inf"), -float("inf"), 1.7976931348623157e308]
    values = [v for v in values if v == v]
    for r in spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits(F.col("v")).alias("b")).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.b == (-bits if r.v < 0 else bits)


def test_outliers_leave_small_cells(spark):
    """Two far values do not put all others into one cell."""
    rows = spark.range(200_000).selectExpr("'k' AS k", "100 + id * 1e-7 AS v").unionByName(
        spark.createDataFrame([("k", 1e300), ("k", -1e300)], "k string, v double"))
    cells = rows.select(ordered_bits(F.col("v")).alias("b")).groupBy(F.shiftright("b", quantiles.SHIFTS[-1])).count()
    assert cells.agg(F.max("count")).first()[0] < 200_000 / 100
    got = exact_quantiles(rows, ["k"], "v", [0.0, 0.5, 1.0], "q").first().q
    assert got == pytest.approx([-1e300, 100 + 99_999.5e-7, 1e300], rel=1e-12)


def test_sketches_merge_within_their_error(spark):
    rows = spark.range(300_000).selectExpr("'k' AS k", "date'2024-01-01' + cast(id % 30 AS int) AS ds", "exp(rand(3) * 20) AS v")
    days = day_sketches(rows, ["k"], "ds", "v")
    assert days.count() == 30
    probs = [0.01, 0.25, 0.5, 0.95, 0.99]
    got = merged_quantiles(days, ["k"], probs, "q").first()
    values = np.sort([r.v for r in rows.select("v").collect()])
    assert got.n == 300_000
    for p, v in zip(probs, got.q):
        assert abs(np.searchsorted(values, v, "right") / len(values) - p) <= quantiles.SKETCH_ERROR


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(5)
    groups = {"wide": rng.lognormal(0, 5, 3000), "ties": rng.integers(0, 5, 2000).astype(float),
              "one": np.array([7.0]), "outlier": np.append(rng.normal(0, 1e-6, 999), 1e12)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, v double")
    probs = [0.0, 0.025, 0.25, 0.5, 0.95, 1.0]
    for r in exact_quantiles(df, ["k"], "v", probs, "q").collect():
        np.testing.assert_allclose(r.q, np.quantile(groups[r.k], probs), rtol=1e-12)


def test_baseline_stats(spark):
    values = np.random.default_rng(9).integers(0, 500, 777).astype(float)
    df = spark.createDataFrame([("c", float(v)) for v in values], "city string, y double")
    got = baseline_stats(df, ["city"]).first()
    assert got.n_samples == 777
    for name, want in (("aqi_mean", values.mean()), ("aqi_std", values.std(ddof=1)), ("aqi_median", np.median(values)),
                       ("aqi_p95", np.quantile(values, 0.95)), ("aqi_min", values.min()), ("aqi_max", values.max())):
        assert got[name] == pytest.approx(want)
    assert baseline_stats(df, ["city"], approximate=True).first().aqi_median == pytest.approx(np.median(values), abs=2)
