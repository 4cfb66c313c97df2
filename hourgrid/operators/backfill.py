"""Backfill requests: validation, chunking, coverage; run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.dimensions import BACKFILL_CHUNK_DAYS, MAX_BACKFILL_DAYS


def validate_requests(requests: DataFrame, start: str = "date_from", end: str = "date_to",
                      as_of: Column | None = None, max_days: int = MAX_BACKFILL_DAYS,
                      known: DataFrame | None = None, key: str = "city") -> DataFrame:
    """Add ``days``, ``valid`` and ``reason``; a missing end means ``as_of``.

    Dates may be text (year-month-day), which comes out parsed. With ``known`` (a column
    ``key``) requests for anything else are invalid too.
    """
    bad = {}
    for name in (start, end):
        if isinstance(requests.schema[name].dataType, T.StringType):
            parsed = F.try_to_timestamp(name, F.lit("yyyy-MM-dd")).cast("timestamp_ntz")
            requests = requests.withColumn(f"__{name}", F.col(name)).withColumn(name, parsed)
            bad[name] = F.col(f"__{name}").isNotNull() & F.col(name).isNull()
    stop = F.col(end) if as_of is None else F.when(~bad.get(end, F.lit(False)), F.coalesce(F.col(end), as_of))
    days = F.floor((F.unix_seconds(stop.cast("timestamp"))
                    - F.unix_seconds(F.col(start).cast("timestamp"))) / 86400).cast("int")
    reason = F.when(F.col(f"__{start}" if start in bad else start).isNull(), f"{start} is required")
    for name, wrong in bad.items():
        reason = reason.when(wrong, F.format_string(f"Invalid {name} format: '%s'. Expected: YYYY-MM-DD", F.col(f"__{name}")))
    reason = (reason.when(F.col(start) >= stop, f"{start} must be before {end}")
              .when(days > max_days, F.format_string(
                  "date range too large: %d days (max %d)", days, F.lit(max_days))))
    if known is not None:
        requests = requests.join(known.select(F.col(key).alias("__key")).distinct(), F.col(key) == F.col("__key"), "left")
        reason = reason.when(F.col("__key").isNull(), F.concat(F.lit(f"unknown {key}: "), F.coalesce(F.col(key), F.lit("none"))))
    return (requests.withColumn("days", days).withColumn("reason", reason).withColumn(end, stop)
            .withColumn("valid", F.col("reason").isNull()).drop("__key", *(f"__{n}" for n in bad)))


def chunk_requests(requests: DataFrame, start: str = "date_from", end: str = "date_to",
                   days: int = BACKFILL_CHUNK_DAYS) -> DataFrame:
    """Split each range into windows of ``days``; the last one ends at the range end."""
    step = F.expr(f"INTERVAL {days} DAYS")
    pieces = requests.filter(F.col(start) < F.col(end)).withColumn(
        "chunk_from", F.explode(F.sequence(F.col(start), F.col(end), step)))
    return (pieces.filter(F.col("chunk_from") < F.col(end))
            .withColumn("chunk_to", F.least(F.col("chunk_from") + step, F.col(end))))


def backfill_coverage(requests: DataFrame, counts: DataFrame, keys: Sequence[str],
                      count: str = "rows") -> DataFrame:
    """Rows loaded against the hours requested, NULL when none were requested."""
    return (requests.join(counts, list(keys), "left")
            .withColumn(count, F.coalesce(count, F.lit(0)))
            .withColumn("expected_hours", F.col("days") * 24)
            .withColumn("coverage_pct", F.try_divide(F.col(count) * 100.0, F.col("expected_hours"))))


def run_summary(series: DataFrame, parts: dict[str, DataFrame], keys: Sequence[str],
                defaults: dict[str, object]) -> DataFrame:
    """Left-join one-row-per-series task results to the series list, with defaults for gaps."""
    out = series.select(*keys)
    for name, df in parts.items():
        out = out.join(df.select(*keys, F.col("value").alias(name)), list(keys), "left")
        if defaults.get(name) is not None:
            out = out.withColumn(name, F.coalesce(F.col(name), F.lit(defaults[name])))
    return out


def dataset_profile(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        F.avg(value).alias("mean_value"), F.max(value).alias("max_value"))


def storage_verification(stores: dict[str, DataFrame], keys: Sequence[str],
                         date: str = "date") -> DataFrame:
    """Number of days, first and last date per series and kind of store."""
    tagged = None
    for kind, df in stores.items():
        part = df.select(*keys, F.lit(kind).alias("kind"), F.col(date).alias("date"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return (tagged.distinct().groupBy(*keys, "kind")
            .agg(F.count("date").alias("days"), F.min("date").alias("first_date"),
                 F.max("date").alias("last_date")))
