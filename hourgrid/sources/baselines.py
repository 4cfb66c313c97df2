"""Stored baselines: every row once, by series and calendar month, with the counts that choose among them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.dimensions import MONTH_MIN_ROWS
from hourgrid.operators.drift import baseline_sample, baseline_sizes


def write_baselines(rows: DataFrame, path: str, keys: Sequence[str], ts: str = "ds", value: str = "y",
                    min_rows: int = MONTH_MIN_ROWS) -> None:
    """Replace the baselines below ``path`` by those of (keys, ds, value) rows.

    ``rows`` lie in folders by series and month: the annual baseline of a series is all its
    folders, that of a month one of them. ``months`` says which months have ``min_rows`` rows.
    """
    known = rows.filter(F.col(value).isNotNull()).select(
        *keys, F.col(ts).alias("ds"), F.col(value).cast("double").alias("aqi"), F.month(ts).alias("month"))
    known.hint("rebalance", *keys, "month").write.mode("overwrite").partitionBy(*keys, "month").parquet(f"{path}/rows")
    stored = rows.sparkSession.read.schema(known.schema).parquet(f"{path}/rows")
    counts = stored.groupBy(*keys, "month").agg(F.count(F.lit(1)).alias("rows")).withColumn("has_baseline", F.col("rows") >= min_rows)
    counts.write.mode("overwrite").parquet(f"{path}/months")


def months_of(spark: SparkSession, path: str) -> DataFrame:
    """(keys, month, rows, has_baseline) of the stored baselines."""
    return spark.read.parquet(f"{path}/months")


def read_baselines(spark: SparkSession, path: str, keys: Sequence[str], month: int | None = None) -> DataFrame:
    """(keys, ds, aqi, month): the rows of ``month`` for series with enough of them, else all of a series.

    Only the folders of the month are read, and of the series that fall back; their names
    come from the small table of counts before the rows are scanned.
    """
    months = months_of(spark, path)
    types = [f"{f.name} {f.dataType.simpleString()}" for f in months.schema if f.name in keys]
    rows = spark.read.schema(f"ds timestamp_ntz, aqi double, {', '.join(types)}, month int").parquet(f"{path}/rows")
    rows = rows.select(*keys, "ds", "aqi", "month")
    if month is None:
        return rows
    seasonal = months.filter((F.col("month") == month) & F.col("has_baseline")).select(*keys)
    others = months.select(*keys).distinct().join(seasonal, list(keys), "left_anti")
    return rows.filter(F.col("month") == month).join(seasonal, list(keys), "left_semi").unionByName(
        rows.join(others, list(keys), "left_semi"))


def write_samples(baseline: DataFrame, path: str, keys: Sequence[str], days: int = 7) -> None:
    """What checks against windows of ``days`` days draw from a baseline, and its size and mean: a few rows a series."""
    baseline_sample(baseline.select(*keys, "ds", "aqi"), keys, days).write.mode("overwrite").parquet(f"{path}/sample")
    baseline_sizes(baseline, keys).write.mode("overwrite").parquet(f"{path}/sizes")


def read_samples(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(sample, sizes) as ``write_samples`` stored them."""
    return spark.read.parquet(f"{path}/sample"), spark.read.parquet(f"{path}/sizes")
