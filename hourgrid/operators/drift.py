"""Two-sample Kolmogorov-Smirnov drift checks per series."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.dimensions import DRIFT_ALPHA, DRIFT_MIN_SAMPLES
from hourgrid.functions.timefns import floor_hour, hour_number
from hourgrid.operators.baseline import baseline_for

# functions of this module travel to the workers by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

P_METHODS = ("exact", "asymptotic")


def recent_hourly(raw: DataFrame, keys: Sequence[str], ts: str, value: str, as_of: Column,
                  days: int = 7) -> DataFrame:
    """Hourly means of the raw rows in the trailing window; the time filter reaches the scan."""
    inside = raw.filter((F.col(ts) >= as_of - F.expr(f"INTERVAL {days} DAYS"))
                        & (F.col(ts) <= as_of) & F.col(value).isNotNull())
    return inside.groupBy(*keys, floor_hour(F.col(ts)).alias("ts")).agg(
        F.avg(value).alias("aqi"))


def hash_sample(rows: DataFrame, sizes: DataFrame, keys: Sequence[str], ts: str,
                size: str, most: int) -> DataFrame:
    """A reproducible sample of ``size`` rows per series, no more than ``most``, chosen by hash order.

    The rows with the smallest hashes: Spark keeps the ``most`` smallest per series in
    every task before it shuffles them, so a series of any length reaches its key as
    that many rows a task.
    """
    digest = F.md5(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    order = Window.partitionBy(*keys).orderBy("__d", ts)
    smallest = rows.withColumn("__d", digest).withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= most)
    return (smallest.join(sizes, list(keys)).filter(F.col("__r") <= F.col(size)).drop("__d", "__r", size))


def ks_statistic(sides: DataFrame, keys: Sequence[str], value: str, side: str) -> DataFrame:
    """Sample sizes ``n1``, ``n2`` and the KS distance as the whole number ``gap = D * n1 * n2``.

    Values are counted per side before anything is ordered, so the cumulative
    pass runs over distinct values only, and it stays in whole numbers.
    """
    counts = sides.groupBy(*keys, value).agg(
        F.count_if(F.col(side) == 1).alias("__c1"), F.count_if(F.col(side) == 2).alias("__c2"))
    totals = Window.partitionBy(*keys)
    running = totals.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cumulative = counts.select(
        *keys, F.sum("__c1").over(running).alias("__u1"), F.sum("__c2").over(running).alias("__u2"),
        F.sum("__c1").over(totals).alias("__n1"), F.sum("__c2").over(totals).alias("__n2"))
    distance = F.abs(F.col("__u1") * F.col("__n2") - F.col("__u2") * F.col("__n1"))
    return cumulative.groupBy(*keys).agg(
        F.max("__n1").alias("n1"), F.max("__n2").alias("n2"), F.max(distance).alias("gap")
    ).withColumn("ks_stat", F.try_divide(F.col("gap").cast("double"),
                                         (F.col("n1") * F.col("n2")).cast("double")))


def equal_size_p(n: Column, h: Column) -> Column:
    """Exact two-sided p-value for two samples of ``n``; ``h`` is ``n * D``, a whole number.

    Alternating sum over lattice paths (Gnedenko and Korolyuk 1951, Hodges 1958);
    every binomial ratio goes on from the last one as a running product, so nothing
    overflows and the cost is linear in ``n``.
    """
    h = F.greatest(h, F.lit(1))
    steps = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.floor(n / h) * h - 1, F.lit(0)))

    def step(acc: Column, j: Column) -> Column:
        ratio = acc["ratio"] * ((n - j).cast("double") / (n + 1 + j).cast("double"))
        term = F.when((j + 1) % h != 0, 0.0).when((j + 1) / h % 2 == 1, ratio).otherwise(-ratio)
        return F.struct(ratio.alias("ratio"), (acc["total"] + term).alias("total"))

    start = F.struct(F.lit(1.0).alias("ratio"), F.lit(0.0).alias("total"))
    return F.least(F.lit(1.0), F.aggregate(steps, start, step)["total"] * 2)


def asymptotic_p(d: Column, n1: Column, n2: Column) -> Column:
    """Kolmogorov's limit distribution."""
    lam = d * F.sqrt(n1 * n2 / (n1 + n2))
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), terms * 2)))


def _stay_probability(n1: int, n2: int, gap: int) -> float:
    """Chance that two pooled samples stay closer than ``gap / (n1 * n2)`` everywhere.

    Draws the pooled ranks one by one: ``stay[i + 1]`` is the chance that i of the ranks
    so far fell to the first sample and no draw left the band. These are probabilities
    throughout, so nothing under- or overflows at any size.
    """
    total = n1 + n2
    stay = np.zeros(n1 + 2)
    stay[1] = 1.0
    for k in range(1, total + 1):
        low = max(0, k - n2, (k * n1 - gap) // total + 1)
        high = min(n1, k, -((-k * n1 - gap) // total) - 1)
        i = np.arange(low, high + 1)
        new = (stay[low + 1:high + 2] * (n2 - k + 1 + i) + stay[low:high + 1] * (n1 - i + 1)) / (total - k + 1)
        stay[low] = 0.0
        stay[low + 1:high + 2] = new
    return float(stay[n1 + 1])


@F.pandas_udf(T.DoubleType())
def unequal_size_p(n1: pd.Series, n2: pd.Series, gap: pd.Series) -> pd.Series:
    """Exact p-value for unequal sizes; one row per series, NULL where it does not apply."""
    return pd.Series([
        None if pd.isna(a) or pd.isna(g) or a == b
        else 1.0 if g <= 0 else min(1.0, max(0.0, 1.0 - _stay_probability(int(a), int(b), int(g))))
        for a, b, g in zip(n1, n2, gap)], dtype="float64")


def with_p_value(ks: DataFrame, method: str = "exact") -> DataFrame:
    """Add ``p_value`` and ``p_method`` (the caller's ``method``) to rows with n1, n2, gap and ks_stat."""
    if method not in P_METHODS:
        raise ValueError(f"method must be one of {P_METHODS}")
    n1, n2, gap = F.col("n1"), F.col("n2"), F.col("gap")
    if method == "asymptotic":
        p_value = asymptotic_p(F.col("ks_stat"), n1, n2)
    else:
        ks = ks.withColumn("__unequal", unequal_size_p(n1, n2, gap))
        p_value = F.when(gap <= 0, F.lit(1.0)).when(
            n1 == n2, equal_size_p(n1, F.floor(gap / F.greatest(n1, F.lit(1))))).otherwise(F.col("__unequal"))
    return ks.withColumn("p_value", p_value).withColumn("p_method", F.lit(method)).drop("__unequal")


def window_hours(days: int) -> int:
    """Hours that a window of ``days`` days, both ends included, has at most."""
    return 24 * days + 1


def baseline_sizes(baseline: DataFrame, keys: Sequence[str]) -> DataFrame:
    return baseline.groupBy(*keys).agg(F.count("aqi").alias("baseline_n"), F.avg("aqi").alias("baseline_mean"))


def baseline_sample(baseline: DataFrame, keys: Sequence[str], days: int = 7) -> DataFrame:
    """All that checks against a window of ``days`` days ever draw from a baseline: a few rows per series."""
    most = window_hours(days)
    sizes = baseline.select(*keys).distinct().withColumn("__size", F.lit(most))
    return hash_sample(baseline, sizes, keys, "ds", "__size", most)


def check_drift(baseline: DataFrame, recent: DataFrame, series: DataFrame, keys: Sequence[str],
                baseline_type: str, as_of: Column, alpha: float = DRIFT_ALPHA,
                min_samples: int = DRIFT_MIN_SAMPLES, method: str = "exact", days: int = 7,
                base_sizes: DataFrame | None = None) -> DataFrame:
    """One result row per series in ``series``; guard failures become ``error`` rows.

    ``baseline`` has (keys, ds, aqi), ``recent`` has (keys, ts, aqi), one row per
    hour of ``days`` days. A longer baseline is sampled down to the size of the recent
    window. Where ``baseline`` is such a sample already, ``base_sizes`` (keys, baseline_n,
    baseline_mean) says what it was drawn from.
    """
    by = list(keys)
    recent_sizes = recent.groupBy(*by).agg(
        F.count("aqi").alias("recent_n"), F.avg("aqi").alias("recent_mean"))
    base_sizes = baseline_sizes(baseline, by) if base_sizes is None else base_sizes
    guarded = (series.select(*by).join(base_sizes, by, "left").join(recent_sizes, by, "left")
               .withColumn("recent_n", F.coalesce("recent_n", F.lit(0)))
               .withColumn("error", F.when(F.coalesce("baseline_n", F.lit(0)) == 0,
                                           "Baseline not found")
                           .when(F.col("recent_n") < min_samples, F.format_string(
                               "Insufficient recent data: %d samples (need %d)",
                               F.col("recent_n"), F.lit(min_samples)))))
    valid = guarded.filter(F.col("error").isNull()).select(*by, F.col("recent_n").alias("__size"))
    sample = hash_sample(baseline, valid, by, "ds", "__size", window_hours(days))
    sides = sample.select(*by, "aqi", F.lit(1).alias("__side")).unionByName(
        recent.join(valid.select(*by), by, "left_semi").select(*by, "aqi", F.lit(2).alias("__side")))
    tested = with_p_value(ks_statistic(sides, by, "aqi", "__side"), method)
    ok = F.col("error").isNull()
    return guarded.join(tested, by, "left").select(
        *by, F.coalesce("p_value", F.lit(1.0)).alias("p_value"),
        F.coalesce("ks_stat", F.lit(0.0)).alias("ks_stat"),
        F.coalesce(F.col("p_value") < alpha, F.lit(False)).alias("is_drifted"),
        F.when(ok, F.col("baseline_mean")).alias("baseline_mean"),
        F.when(ok, F.col("recent_mean")).alias("recent_mean"),
        F.when(ok, F.col("recent_n")).otherwise(0).cast("int").alias("recent_n"),
        F.lit(baseline_type).alias("baseline_type"),
        as_of.cast("timestamp_ntz").alias("checked_at"), "error")


def drift_report(features: DataFrame, raw: DataFrame, series: DataFrame, keys: Sequence[str],
                 ts: str, value: str, as_of: str, days: int = 7,
                 seasonal: bool = False, method: str = "exact") -> DataFrame:
    """Baseline choice, recent window and test in one plan. ``as_of`` is ISO text."""
    moment = F.lit(as_of).cast("timestamp_ntz")
    month = int(as_of[5:7]) if seasonal else None
    return check_drift(baseline_for(features, keys, month),
                       recent_hourly(raw, keys, ts, value, moment, days),
                       series, keys, "seasonal" if seasonal else "annual", moment, method=method, days=days)


def retrain_list(results: DataFrame) -> DataFrame:
    """Series that drifted and whose check did not fail."""
    return results.filter(F.col("is_drifted") & F.col("error").isNull())
