"""Seasonal-naive forecasts with intervals, future frames and forecast output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.dimensions import DEFAULT_INDEX, REGRESSORS, WEATHER_COLS
from hourgrid.functions.index import aqi_category, clip_index, whole_index
from hourgrid.functions.timefns import (
    floor_hour, local_iso, rush_hour, with_season_effects)
from hourgrid.operators.features import BUCKET_HOURS, with_halo
from hourgrid.operators.quantiles import exact_quantiles

MAX_HORIZON = 48


def seasonal_naive(df: DataFrame, keys: Sequence[str], ts: str = "ds", y: str = "y",
                   season: int = 24, split: str = "split", interval_width: float = 0.95,
                   bucket_hours: int = BUCKET_HOURS) -> DataFrame:
    """Value of one season ago, else the training mean of that hour of the week, else of the series.

    Intervals are training-residual quantiles by hour of day. ``df`` carries a
    ``split`` column with ``train``/``test``; all rows get a forecast.
    """
    by = list(keys)
    train = F.col(split) == "train"
    order = Window.partitionBy(*by, "__b").orderBy("__h").rangeBetween(-season, -season)
    lagged = (with_halo(df, ts, season, bucket_hours)
              .withColumn("__lag", F.first(y).over(order)).filter("__own").drop("__h", "__b", "__own"))
    lagged = lagged.withColumns({"__hod": F.hour(ts), "__how": F.weekday(ts) * 24 + F.hour(ts)})
    known = df.filter(train)
    weekly = known.groupBy(*by, (F.weekday(ts) * 24 + F.hour(ts)).alias("__how")).agg(
        F.sum(y).alias("__sum"), F.count(y).alias("__n"))
    # one row per series with its 168 hour-of-week means, and the mean over all of them
    means = weekly.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("__how", F.col("__sum") / F.col("__n")))).alias("__weekly"),
        (F.sum("__sum") / F.sum("__n")).alias("__overall"))
    usual = F.try_element_at("__weekly", F.col("__how"))
    forecast = (lagged.join(means, by, "left")
                .withColumn("yhat", clip_index(F.coalesce("__lag", usual, "__overall"))).drop("__weekly"))
    tail = round((1.0 - interval_width) / 2, 12)
    residuals = forecast.filter(train & F.col("__lag").isNotNull()).select(
        *by, "__hod", (F.col(y) - F.col("yhat")).alias("__e"))
    spread = exact_quantiles(residuals, [*by, "__hod"], "__e", [tail, 1.0 - tail], "__q")
    return (forecast.join(spread, [*by, "__hod"], "left")
            .withColumn("yhat_lower", clip_index(F.col("yhat") + F.coalesce(F.col("__q")[0], F.lit(0.0))))
            .withColumn("yhat_upper", clip_index(F.col("yhat") + F.coalesce(F.col("__q")[1], F.lit(0.0))))
            .select(*df.columns, "yhat", "yhat_lower", "yhat_upper"))


def future_hours(series: DataFrame, keys: Sequence[str], as_of: Column, horizon: int = 24) -> DataFrame:
    """The next ``horizon`` hours per series, starting with the hour of ``as_of``."""
    if not 1 <= horizon <= MAX_HORIZON:
        raise ValueError(f"horizon must be between 1 and {MAX_HORIZON} hours")
    start = floor_hour(as_of)
    hours = F.sequence(start, start + F.expr(f"INTERVAL {horizon - 1} HOURS"), F.expr("INTERVAL 1 HOUR"))
    return series.select(*keys, F.explode(hours).alias("ds"))


def next_hours(weather: DataFrame, keys: Sequence[str], ts: str, as_of: Column, n: int = 24) -> DataFrame:
    """The first ``n`` rows at or after ``as_of`` per series.

    Only hours from ``as_of`` on are read; a forecast feed holds a few days of them.
    """
    order = Window.partitionBy(*keys).orderBy(ts)
    return (weather.filter(F.col(ts) >= as_of).withColumn("__r", F.row_number().over(order))
            .filter(F.col("__r") <= n).drop("__r"))


def future_frame(series: DataFrame, keys: Sequence[str], as_of: Column, horizon: int = 24,
                 weather: DataFrame | None = None, weather_means: DataFrame | None = None,
                 current: DataFrame | None = None, recent: DataFrame | None = None,
                 regressors: Sequence[str] = tuple(REGRESSORS)) -> DataFrame:
    """Regressors for the next hours, each with its fallback chain.

    * weather: forecast hour, then recent mean, then 0
    * lag regressors: current index (``current``: keys, value), else the default
    * rolling regressors: recent mean index (``recent``: keys, value), else the default
    * calendar: from the timestamp
    """
    by = list(keys)
    frame = future_hours(series, by, as_of, horizon)
    wanted = [c for c in WEATHER_COLS if c in regressors]
    if weather is not None:
        present = [c for c in wanted if c in weather.columns]
        frame = frame.join(weather.select(*by, floor_hour(F.col("ts")).alias("ds"), *present),
                           [*by, "ds"], "left")
    if weather_means is not None:
        present = [c for c in wanted if c in weather_means.columns]
        frame = frame.join(weather_means.select(*by, *[F.col(c).alias(f"__m_{c}") for c in present]),
                           by, "left")
    filled = {}
    for c in wanted:
        chain = [F.col(name) for name in (c, f"__m_{c}") if name in frame.columns]
        filled[c] = F.coalesce(*chain, F.lit(0.0))
    for name, df in (("__current", current), ("__recent", recent)):
        if df is not None:
            frame = frame.join(df.select(*by, F.col("value").alias(name)), by, "left")
    for c in regressors:
        if "lag" in c or "roll" in c:
            source = "__current" if "lag" in c else "__recent"
            known = F.col(source) if source in frame.columns else F.lit(None).cast("double")
            filled[c] = F.coalesce(known, F.lit(DEFAULT_INDEX))
    if "is_rush_hour" in regressors:
        filled["is_rush_hour"] = rush_hour(F.col("ds")).cast("int")
    out = with_season_effects(frame.withColumns(filled), "ds").withColumn("temp_inversion", F.lit(0.0))
    return out.select(*by, "ds", *[c for c in regressors if c in out.columns],
                      *[c for c in ("crop_burning", "festival_period", "temp_inversion")
                        if c not in regressors])


def forecast_output(forecast: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Display rows: UTC and local time, whole index values, category struct."""
    aqi = whole_index(clip_index(F.col("yhat")))
    return forecast.select(
        *keys, F.date_format("ds", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        local_iso(F.col("ds")).alias("timestamp_ist"), aqi.alias("aqi"),
        whole_index(clip_index(F.col("yhat_lower"))).alias("aqi_lower"),
        whole_index(clip_index(F.col("yhat_upper"))).alias("aqi_upper"),
        aqi_category(aqi).alias("category"))


def forecast_headline(rows: DataFrame, keys: Sequence[str], ts: str, aqi: str) -> DataFrame:
    """Mean of the first six hours, and the peak and low of a short forecast."""
    order = Window.partitionBy(*keys).orderBy(ts)
    first_six = F.when(F.col("__r") <= 6, F.col(aqi))
    return (rows.withColumn("__r", F.row_number().over(order)).groupBy(*keys).agg(
        F.avg(first_six).alias("next_6h_avg"), F.max(aqi).alias("peak"), F.min(aqi).alias("low")))
