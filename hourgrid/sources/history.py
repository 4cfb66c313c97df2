"""Historical CSV files: scan, clean, split into readings and weather."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.dimensions import BONUS_RENAMES, HISTORY_REQUIRED, WEATHER_COLS, WEATHER_RENAMES
from hourgrid.functions.index import pm25_to_aqi
from hourgrid.functions.timefns import floor_hour
from hourgrid.operators.dedupe import first_wins
from hourgrid.operators.quality import (
    coerce, kmh_to_ms, missing_columns, normalise_aliases, physical_bounds, provenance,
    with_missing_as_null)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all columns as text, and ``ingest_seq``: a row's file and place in it.

    Missing required columns only warn.
    """
    df = spark.read.csv(path, header=True, inferSchema=False, mode="PERMISSIVE")
    df = df.withColumn("ingest_seq", F.struct("_metadata.file_path", "_metadata.file_block_start",
                                              F.monotonically_increasing_id().alias("row")))
    absent = missing_columns(df, HISTORY_REQUIRED)
    if absent:
        warnings.warn(f"missing expected columns: {absent}", stacklevel=2)
    return df


def _stamped(df: DataFrame) -> DataFrame:
    named = normalise_aliases(df, "City").withColumnRenamed("City", "city")
    stamped = coerce(named, timestamps={"Datetime": ""}, required=["Datetime"])
    return stamped.withColumn("timestamp", floor_hour(F.col("Datetime"))).drop("Datetime")


def readings(df: DataFrame, order: Sequence[str] = ("ingest_seq",)) -> DataFrame:
    """Clean readings, the first of each city and hour in order, with provenance columns and the index."""
    rows = coerce(_stamped(df), numbers=["PM2_5_ugm3"], required=["PM2_5_ugm3"])
    rows = provenance(physical_bounds(rows, "PM2_5_ugm3"), "PM2_5_ugm3", "history")
    rows = rows.withColumn("aqi", pm25_to_aqi(F.col("pm25")))
    one = first_wins(rows, ["city", "timestamp"], [F.col(c) for c in order])
    return one.select("timestamp", "pm25", "pm25_min", "pm25_max", "pm25_sd", "coverage_pct",
                      "aqi", "city", "location_id")


def weather(df: DataFrame, order: Sequence[str] = ("ingest_seq",)) -> DataFrame:
    """Weather columns with internal names; wind in m/s; optional extras where present.

    Of each city and hour the first row in order that has a temperature, else the first.
    """
    rows = with_missing_as_null(_stamped(df), list(WEATHER_RENAMES), "string")
    rows = coerce(rows, numbers=list(WEATHER_RENAMES)).withColumn(
        "Wind_Speed_10m_kmh", kmh_to_ms(F.col("Wind_Speed_10m_kmh")))
    one = first_wins(rows, ["city", "timestamp"], [F.col("Temp_2m_C").isNull(), *(F.col(c) for c in order)])
    extras = [c for c in BONUS_RENAMES if c in one.columns]
    return one.withColumnsRenamed({**WEATHER_RENAMES, **BONUS_RENAMES}).select(
        "timestamp", "city", *WEATHER_COLS, *[BONUS_RENAMES[c] for c in extras])
