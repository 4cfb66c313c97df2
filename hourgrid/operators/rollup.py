"""Hourly rollups: station-hour, city-hour and recent windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.index import pm25_to_aqi
from hourgrid.functions.timefns import floor_hour


def mean_of(column: str, decimals: int | None = None) -> Column:
    """Mean of a column.

    With ``decimals`` the values are summed as whole numbers of that precision:
    the result then does not depend on the order in which partial sums arrive,
    so a recomputed task gives the same bits.
    """
    if decimals is None:
        return F.avg(column)
    scale = 10 ** decimals
    total = F.sum(F.round(F.col(column) * scale).cast("bigint"))
    return total.cast("double") / (F.count(column) * scale).cast("double")


def hourly_mean(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                decimals: int | None = None, out: str | None = None) -> DataFrame:
    """One row per key and hour: mean over all raw rows and their number."""
    return (df.dropna(subset=[ts, value])
            .groupBy(*keys, floor_hour(F.col(ts)).alias(ts))
            .agg(mean_of(value, decimals).alias(out or value), F.count(value).alias("n")))


def station_hour_rollup(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "pm25",
                        low: str | None = None, high: str | None = None, sd: str | None = None,
                        coverage: str | None = None, decimals: int | None = None) -> DataFrame:
    """Per station and hour: mean value, extremes, mean sd, mean coverage, index of the mean."""
    aggs = [mean_of(value, decimals).alias("pm25"),
            F.min(low or value).alias("pm25_min"),
            F.max(high or value).alias("pm25_max"),
            (F.avg(sd) if sd else F.avg(F.lit(None).cast("double"))).alias("pm25_sd"),
            (F.avg(coverage) if coverage else F.avg(F.lit(100.0))).alias("coverage_pct")]
    out = df.groupBy(*keys, floor_hour(F.col(ts)).alias("ts")).agg(*aggs)
    return out.withColumn("aqi", pm25_to_aqi(F.col("pm25")))


def city_hour_rollup(station_hours: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Mean of the station means per hour, and the index of that mean."""
    out = station_hours.groupBy(*keys, ts).agg(
        F.avg("pm25").alias("pm25"), F.min("pm25_min").alias("pm25_min"),
        F.max("pm25_max").alias("pm25_max"), F.avg("pm25_sd").alias("pm25_sd"),
        F.avg("coverage_pct").alias("coverage_pct"))
    return out.withColumn("aqi", pm25_to_aqi(F.col("pm25")))


def recent_window_rollup(station_hours: DataFrame, keys: Sequence[str], as_of: Column,
                         days: int = 7, ts: str = "ts") -> DataFrame:
    """Trailing window per hour: mean value, and half-even rounded mean of the *indices*."""
    recent = station_hours.filter(
        (F.col(ts) >= as_of - F.expr(f"INTERVAL {days} DAYS")) & (F.col(ts) <= as_of))
    return recent.groupBy(*keys, ts).agg(
        F.avg("pm25").alias("pm25"), F.rint(F.avg("aqi")).cast("int").alias("aqi"))
