"""Lag, rolling and calendar features of hourly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.dimensions import LAG_HOURS, ROLLING_WINDOWS, WEATHER_COLS
from hourgrid.functions.timefns import (
    floor_day, hour_number, with_calendar, with_cyclic, with_season_effects)
from hourgrid.operators.quality import with_missing_as_null

BUCKET_HOURS = 24 * 30


def with_halo(df: DataFrame, ts: str, halo_hours: int, bucket_hours: int = BUCKET_HOURS) -> DataFrame:
    """Cut series into time buckets and copy each bucket's tail into the next one.

    Adds ``__h`` (hour number), ``__b`` (bucket) and ``__own`` (false for copies).
    Windows partitioned by key *and* bucket then see ``halo_hours`` of history,
    and a single long series spreads over as many tasks as it has buckets. Cost:
    ``halo_hours / bucket_hours`` extra rows.
    """
    if halo_hours > bucket_hours:
        raise ValueError("a halo must not be longer than a bucket")
    hour = hour_number(F.col(ts))
    bucket = F.floor(F.col("__h") / bucket_hours)
    in_tail = F.pmod(F.col("__h"), F.lit(bucket_hours)) >= bucket_hours - halo_hours
    homes = F.when(in_tail, F.array(bucket, bucket + 1)).otherwise(F.array(bucket))
    return (df.withColumn("__h", hour).select("*", F.posexplode(homes).alias("__copy", "__b"))
            .withColumn("__own", F.col("__copy") == 0).drop("__copy"))


def series_bounds(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """Per series: grid start, grid end and the mean of the values on the grid.

    The newest row is off the grid when it falls exactly on midnight; its value
    is then taken out of the mean. One pass, no second read of the series.
    """
    newest_off = floor_day(F.col("__max")) == F.col("__max")
    total = F.col("__sum") - F.when(newest_off, F.col("__newest")).otherwise(F.lit(0.0))
    count = F.col("__n") - F.when(newest_off, 1).otherwise(0)
    end = F.when(newest_off, F.col("__max")).otherwise(
        floor_day(F.col("__max")) + F.expr("INTERVAL 1 DAY")) - F.expr("INTERVAL 1 HOUR")
    return (df.groupBy(*keys)
            .agg(F.min(ts).alias("__min"), F.max(ts).alias("__max"), F.sum(value).alias("__sum"),
                 F.count(value).alias("__n"), F.max_by(value, ts).alias("__newest"))
            .filter(F.col("__n") > 0)
            .select(*keys, floor_day(F.col("__min")).alias("__start"), end.alias("__end"),
                    F.try_divide(total, count).alias("__mean")))


def with_series_windows(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                        lags: Sequence[int] = tuple(LAG_HOURS),
                        windows: Sequence[tuple[int, str]] = tuple(ROLLING_WINDOWS),
                        include_current: bool = True, prefix: str = "aqi",
                        bucket_hours: int = BUCKET_HOURS) -> DataFrame:
    """Lags and rolling mean/std/max as on a complete hourly grid, without making the grid.

    ``df`` has one row per key and hour and no NULL values. Frames are ranges
    of hours, so a missing hour counts as a grid hour without a value:

    * lag ``h`` is the value exactly ``h`` hours back; where that hour has none,
      the next known value after it whose own lag position is still on the grid
      (a backward fill of the lag column), else the series mean. The current row
      has a value, so that search never leaves the last ``h`` hours.
    * rolling statistics skip missing hours; an undefined one (the deviation of
      a single value) becomes the series mean.

    All frames share one partitioning by (keys, time bucket): one shuffle of the
    hourly rows, whatever the number of features.
    """
    reach = max([*lags, *[h for h, _ in windows]], default=0)
    bounds = series_bounds(df, keys, ts, value)
    on_grid = df.join(bounds, list(keys)).filter(F.col(ts) <= F.col("__end"))
    halo = with_halo(on_grid, ts, reach, bucket_hours)
    order = Window.partitionBy(*keys, "__b").orderBy("__h")
    v, mean = F.col(value), F.col("__mean")
    end_hour = hour_number(F.col("__end"))

    found = {}
    for lag in lags:
        frame = order.rangeBetween(-lag, 0)
        found[f"__v{lag}"] = F.first(v).over(frame)
        found[f"__h{lag}"] = F.first("__h").over(frame)
    newest = 0 if include_current else -1
    for hours, name in windows:
        frame = order.rangeBetween(newest - hours + 1, newest)
        found[f"__mean_{name}"] = F.avg(v).over(frame)
        found[f"__std_{name}"] = F.stddev_samp(v).over(frame)
        found[f"__max_{name}"] = F.max(v).over(frame)
    rolled = halo.select("*", *[c.alias(n) for n, c in found.items()]).filter("__own")

    features = {}
    for lag in lags:
        reachable = F.col(f"__h{lag}") + lag <= end_hour
        features[f"{prefix}_lag_{lag}h"] = F.when(reachable, F.col(f"__v{lag}")).otherwise(mean)
    for hours, name in windows:
        for stat in ("mean", "std", "max"):
            features[f"{prefix}_roll_{stat}_{name}"] = F.coalesce(F.col(f"__{stat}_{name}"), mean)
    return rolled.select(*df.columns, *[c.alias(n) for n, c in features.items()])


def weather_on_grid(weather: DataFrame, bounds: DataFrame, keys: Sequence[str], ts: str,
                    columns: Sequence[str]) -> DataFrame:
    """Series means of the weather hours that lie on the grid (the fill values)."""
    inside = weather.join(bounds, list(keys)).filter(
        F.col(ts).between(F.col("__start"), F.col("__end")))
    return inside.groupBy(*keys).agg(*[F.avg(c).alias(f"__w_{c}") for c in columns])


def feature_table(hourly: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "aqi",
                  weather: DataFrame | None = None, lags: Sequence[int] = tuple(LAG_HOURS),
                  windows: Sequence[tuple[int, str]] = tuple(ROLLING_WINDOWS),
                  include_current: bool = True, bucket_hours: int = BUCKET_HOURS) -> DataFrame:
    """The full feature table: one row per observed hour, time as ``ds``, target as ``y``.

    ``hourly`` has one row per key and hour; ``weather`` too (or is None, which
    gives NULL weather columns). Weather gaps get the series mean.
    """
    observed = hourly.filter(F.col(value).isNotNull()).withColumn(value, F.col(value).cast("double"))
    rows = with_series_windows(observed, keys, ts, value, lags, windows, include_current,
                               bucket_hours=bucket_hours)
    if weather is None:
        rows = with_missing_as_null(rows, WEATHER_COLS)
    else:
        columns = [c for c in weather.columns if c not in (*keys, ts)]
        numeric = [c for c in columns if c in WEATHER_COLS]
        bounds = series_bounds(observed, keys, ts, value)
        means = weather_on_grid(weather, bounds, keys, ts, numeric)
        rows = (rows.join(weather, [*keys, ts], "left").join(means, list(keys), "left")
                .withColumns({c: F.coalesce(c, f"__w_{c}") for c in numeric})
                .drop(*[f"__w_{c}" for c in numeric]))
    rows = with_cyclic(with_calendar(with_season_effects(rows, ts), ts))
    return rows.withColumnsRenamed({ts: "ds", value: "y"})
