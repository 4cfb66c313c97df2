"""Baseline distributions and their statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.dimensions import MONTH_MIN_ROWS
from hourgrid.operators.quantiles import exact_quantiles

PROBS = [0.25, 0.5, 0.75, 0.95]


def baseline_stats(df: DataFrame, keys: Sequence[str], value: str = "y",
                   weather_means: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Count, mean, sample deviation, median, p25, p75, p95, min, max and weather means."""
    extra = {c: name for c, name in
             (("wind_speed_10m", "wind_mean"), ("temperature_2m", "temp_mean")) if c in weather_means}
    basic = df.groupBy(*keys).agg(
        F.count(value).alias("n_samples"), F.avg(value).alias("aqi_mean"),
        F.stddev_samp(value).alias("aqi_std"), F.min(value).alias("aqi_min"),
        F.max(value).alias("aqi_max"), *[F.avg(c).alias(n) for c, n in extra.items()])
    if approximate:
        points = df.groupBy(*keys).agg(F.percentile_approx(value, PROBS, 10000).alias("__q"))
    else:
        points = exact_quantiles(df, keys, value, PROBS, "__q")
    named = {n: F.col("__q")[i] for i, n in enumerate(["aqi_p25", "aqi_median", "aqi_p75", "aqi_p95"])}
    return basic.join(points, list(keys), "left").withColumns(named).drop("__q")


def month_counts(df: DataFrame, keys: Sequence[str], ts: str = "ds",
                 min_rows: int = MONTH_MIN_ROWS) -> DataFrame:
    """Rows per calendar month over all years, and whether the month has a baseline of its own."""
    return (df.groupBy(*keys, F.month(F.col(ts)).alias("month"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("has_baseline", F.col("rows") >= min_rows))


def monthly_baseline(df: DataFrame, keys: Sequence[str], ts: str = "ds", value: str = "y",
                     min_rows: int = MONTH_MIN_ROWS) -> DataFrame:
    """Baseline rows of the months that have enough of them."""
    kept = month_counts(df, keys, ts, min_rows).filter("has_baseline").select(*keys, "month")
    return (df.select(*keys, F.col(ts).alias("ds"), F.col(value).alias("aqi"))
            .withColumn("month", F.month("ds")).join(kept, [*keys, "month"], "left_semi"))


def baseline_for(df: DataFrame, keys: Sequence[str], month: int | None, ts: str = "ds",
                 value: str = "y", min_rows: int = MONTH_MIN_ROWS) -> DataFrame:
    """Rows to compare against: those of ``month`` where a series has enough, else all."""
    rows = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(ts).alias("ds"), F.col(value).cast("double").alias("aqi"))
    if month is None:
        return rows
    same = F.month("ds") == month
    gate = rows.groupBy(*keys).agg((F.count_if(same) >= min_rows).alias("__seasonal"))
    return (rows.join(gate, list(keys)).filter(~F.col("__seasonal") | same).drop("__seasonal"))
