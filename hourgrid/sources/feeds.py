"""Parsers for landed payloads: measurement pages, sensor lists, weather arrays, live readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.dimensions import WEATHER_COLS
from hourgrid.functions.index import pm25_to_aqi
from hourgrid.functions.timefns import floor_hour, local_to_utc, parse_offset_timestamp, utc_wall
from hourgrid.operators.quality import physical_bounds, provenance, quality_filter
from hourgrid.operators.rollup import mean_of
from hourgrid.sources.schemas import LIVE_READING, MEASUREMENT_PAGE, SENSOR_PAGE, WEATHER_PAGE


def measurements(pages: DataFrame, keys: Sequence[str], payload: str) -> DataFrame:
    """Measurement pages (JSON text) to one row per usable record.

    A record without a readable period, with a flag, with less than half
    coverage or out of physical bounds is dropped; a payload that does not
    parse gives no rows.
    """
    records = pages.select(*keys, F.explode(
        F.from_json(payload, MEASUREMENT_PAGE)["results"]).alias("r"))
    rows = records.select(
        *keys,
        floor_hour(utc_wall(F.try_to_timestamp(F.col("r.period.datetimeTo.utc")))).alias("ts"),
        F.col("r.value").alias("pm25"), F.col("r.summary.min").alias("pm25_min"),
        F.col("r.summary.max").alias("pm25_max"), F.col("r.summary.sd").alias("pm25_sd"),
        F.coalesce(F.col("r.coverage.percentCoverage"), F.lit(100.0)).alias("coverage_pct"),
        F.col("r.flagInfo.hasFlags").alias("flagged"))
    usable = quality_filter(rows.dropna(subset=["ts"]), "pm25", "coverage_pct", "flagged")
    return physical_bounds(usable, "pm25").drop("flagged")


def measurements_hourly(pages: DataFrame, keys: Sequence[str], payload: str,
                        decimals: int | None = None) -> DataFrame:
    """Measurement pages to one row per key and hour with the index of the mean."""
    rows = measurements(pages, keys, payload)
    out = rows.groupBy(*keys, "ts").agg(
        mean_of("pm25", decimals).alias("pm25"), F.min("pm25_min").alias("pm25_min"),
        F.max("pm25_max").alias("pm25_max"), F.avg("pm25_sd").alias("pm25_sd"),
        F.avg("coverage_pct").alias("coverage_pct"))
    return out.withColumn("aqi", pm25_to_aqi(F.col("pm25")))


def sensors(pages: DataFrame, keys: Sequence[str], payload: str) -> DataFrame:
    """Sensor lists to rows with sensor id, parameter and position in the list."""
    listed = pages.select(*keys, F.posexplode(
        F.from_json(payload, SENSOR_PAGE)["results"]).alias("position", "s"))
    return listed.select(*keys, "position", F.col("s.id").alias("sensor"),
                         F.col("s.parameter.name").alias("parameter"))


def weather_arrays(pages: DataFrame, keys: Sequence[str], payload: str,
                   local: bool = True) -> DataFrame:
    """Parallel hourly arrays to rows; a missing variable is NULL, rows need a temperature."""
    parsed = pages.select(*keys, F.from_json(payload, WEATHER_PAGE)["hourly"].alias("h"))
    zipped = F.arrays_zip(F.col("h.time").alias("time"),
                          *[F.coalesce(F.col(f"h.{c}"), F.array().cast("array<double>")).alias(c)
                            for c in WEATHER_COLS])
    rows = parsed.filter(F.col("h.time").isNotNull()).select(*keys, F.inline(zipped))
    stamp = F.try_to_timestamp(F.col("time")).cast("timestamp_ntz")
    return (rows.withColumn("ts", local_to_utc(stamp) if local else stamp)
            .dropna(subset=["ts", "temperature_2m"]).select(*keys, "ts", *WEATHER_COLS))


def live_readings(pages: DataFrame, keys: Sequence[str], payload: str, as_of: Column) -> DataFrame:
    """Live payloads to rows; failed ones and those without an index are dropped.

    The source has no concentration, so the index is stored as a stand-in and
    the row is marked with location -1.
    """
    parsed = pages.select(*keys, F.from_json(payload, LIVE_READING).alias("j"))
    good = parsed.filter((F.col("j.status") == "ok") & F.col("j.data.aqi").isNotNull())
    members = {"temperature": "t", "humidity": "h", "wind_speed": "w", "wind_dir": "wd",
               "wind_gust": "wg", "pressure": "p", "dew_point": "dew"}
    rows = good.select(
        *keys, parse_offset_timestamp(F.col("j.data.time.s"), F.col("j.data.time.tz"), as_of).alias("ts"),
        F.col("j.data.aqi").alias("aqi"),
        *[F.col(f"j.data.iaqi.{m}.v").alias(name) for name, m in members.items()])
    return provenance(rows, "aqi", "live").withColumn("source", F.lit("live"))
