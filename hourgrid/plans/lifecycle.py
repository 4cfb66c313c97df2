"""The working day of the system: ingest, features, drift, training, evaluation, forecast.

Every step reads tables and writes tables below one root folder, for all cities
at once. A step can be repeated: stores merge first-wins or are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.dimensions import BONUS_COLS, REGRESSORS, WEATHER_COLS, cities
from hourgrid.functions.timefns import floor_hour
from hourgrid.operators import autoregression, baseline, drift, forecast, lookups, metrics, registry, regression
from hourgrid.operators.dedupe import first_wins
from hourgrid.operators.features import feature_table
from hourgrid.operators.quality import keep_present, wind_unit_fix
from hourgrid.operators.rollup import city_hour_rollup
from hourgrid.session import saved
from hourgrid.sources import baselines, feeds, history, stores

KEYS = ["city"]
#: What a model may use, where the features have values for it
CANDIDATES = (*REGRESSORS, *BONUS_COLS)


@dataclass(frozen=True)
class Layout:
    """Where the tables lie."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name not in {"readings", "weather", "features", "baseline", "stats", "drift", "recent",
                        "models", "versions", "reports", "baseline_scores"}:
            raise AttributeError(name)
        return f"{self.root}/{name}"


def _moment(as_of: str):
    return F.lit(as_of).cast("timestamp_ntz")


def ingest_measurements(spark: SparkSession, at: Layout, pages: DataFrame) -> None:
    """Measurement pages (city, location_id, payload) into the readings store."""
    station_hours = feeds.measurements_hourly(pages, ["city", "location_id"], "payload")
    rows = city_hour_rollup(station_hours, KEYS)
    stores.upsert_days(spark, at.readings, rows, KEYS, "ts", [F.col("pm25")])


def ingest_live(spark: SparkSession, at: Layout, pages: DataFrame, as_of: str) -> None:
    """Live payloads (city, payload) into the readings store."""
    rows = feeds.live_readings(pages, KEYS, "payload", _moment(as_of))
    keep = ["city", "ts", "pm25", "pm25_min", "pm25_max", "pm25_sd", "coverage_pct", "aqi", "location_id"]
    stores.upsert_days(spark, at.readings, rows.select(*keep), KEYS, "ts", [F.col("aqi")])


def ingest_weather(spark: SparkSession, at: Layout, pages: DataFrame) -> None:
    """Weather pages (city, payload) into the weather store."""
    rows = feeds.weather_arrays(pages, KEYS, "payload")
    stores.upsert_days(spark, at.weather, rows, KEYS, "ts", [F.col(c) for c in WEATHER_COLS])


def ingest_history(spark: SparkSession, at: Layout, path: str) -> None:
    """A history file into both stores."""
    df = history.read_history(spark, path)
    rows = history.readings(df).withColumnRenamed("timestamp", "ts")
    wx = history.weather(df).withColumnRenamed("timestamp", "ts")
    stores.upsert_days(spark, at.readings, rows, KEYS, "ts", [F.col("pm25")])
    stores.upsert_days(spark, at.weather, wx, KEYS, "ts", [F.col("temperature_2m")])


def hourly_readings(spark: SparkSession, at: Layout, until: str | None = None) -> DataFrame:
    """One reading per city and hour: live rows carry minutes, so the store may hold several."""
    rows = stores.read_store(spark, at.readings).filter(F.col("aqi").isNotNull())
    rows = rows if until is None else stores.within(rows, None, _moment(until))
    order = [F.col("arrived"), F.col("pm25")]
    exact = rows.select("city", floor_hour(F.col("ts")).alias("ts"), F.col("ts").alias("arrived"),
                        F.col("pm25").cast("double").alias("pm25"), F.col("aqi").cast("int").alias("aqi"))
    return first_wins(exact, ["city", "ts"], order).drop("arrived")


def hourly_weather(spark: SparkSession, at: Layout) -> DataFrame:
    if not stores.exists(spark, at.weather):
        return stores.read_weather_or_null(spark, at.weather, hourly_readings(spark, at), ["city", "ts"])
    rows = stores.read_store(spark, at.weather)
    rows = keep_present(rows.withColumn("ts", floor_hour(F.col("ts"))), ["city", "ts", *WEATHER_COLS, "temp_inversion"])
    if "temp_inversion" in rows.columns:  # crop burning and festivals follow from the calendar
        rows = rows.withColumn("temp_inversion", F.col("temp_inversion").try_cast("double"))
    present = [c for c in rows.columns if c in WEATHER_COLS]
    if "wind_speed_10m" in present:
        rows = wind_unit_fix(rows, KEYS)
    return first_wins(rows, ["city", "ts"], [F.col(c) for c in present])


def build_features(spark: SparkSession, at: Layout) -> None:
    """Feature table, baselines (all rows and by month) and their statistics."""
    stores.write_features(feature_table(hourly_readings(spark, at), KEYS, weather=hourly_weather(spark, at)),
                          at.features)
    features = spark.read.parquet(at.features)
    baselines.write_baselines(features, at.baseline, KEYS)
    weather = [c for c in ("wind_speed_10m", "temperature_2m") if c in features.columns]
    stores.write_json(baseline.baseline_stats(features, KEYS, weather_means=weather), at.stats)


def check_drift(spark: SparkSession, at: Layout, as_of: str, seasonal: bool = False, days: int = 7) -> DataFrame:
    """Drift rows of all registered cities, saved with the recent window they looked at.

    The baselines are read from their store: of the month of ``as_of`` where a city has
    one and ``seasonal`` is asked for, else of all months. Features are not read.
    """
    raw = stores.within(stores.read_store(spark, at.readings), _moment(as_of) - F.expr(f"INTERVAL {days} DAYS"), _moment(as_of))
    recent = drift.recent_hourly(raw, KEYS, "ts", "aqi", _moment(as_of), days)
    stores.write_snapshot(recent, at.recent, as_of)
    stored = baselines.read_baselines(spark, at.baseline, KEYS, int(as_of[5:7]) if seasonal else None)
    results = drift.check_drift(stored, spark.read.parquet(at.recent), cities(spark).select("city"), KEYS,
                                "seasonal" if seasonal else "annual", _moment(as_of), days=days)
    results.write.mode("overwrite").parquet(at.drift)
    return spark.read.parquet(at.drift)


def _model(features: DataFrame, regressors: Sequence[str]) -> regression.SeasonalModel:
    """The model with the candidates that have any value; one row a candidate reaches the driver."""
    present = [r for r in regressors if r in features.columns]
    found = regression.regressor_availability(features, present).filter("available").collect() if present else []
    usable = {r.regressor for r in found}
    return regression.SeasonalModel(regressors=tuple(r for r in present if r in usable))


def _predicted(champions: DataFrame, frame: Callable[[regression.SeasonalModel], DataFrame]) -> DataFrame:
    """Forecasts by champions of any shape: each scores the frame made for its own shape."""
    spark = champions.sparkSession
    kinds = dict(champions.dtypes)
    out = spark.createDataFrame([], f"city {kinds['city']}, ds timestamp_ntz, yhat double, yhat_lower double, yhat_upper double")
    for shape in sorted(r.shape for r in champions.select("shape").distinct().collect()):
        model = regression.SeasonalModel.of_shape(shape)
        part = regression.predict(frame(model), champions.filter(F.col("shape") == shape), KEYS, model=model)
        out = out.unionByName(part.select(out.columns))
    return out


def train(spark: SparkSession, at: Layout, version: int, trained_at: str, only: DataFrame | None = None,
          test_days: int = 7, regressors: Sequence[str] = CANDIDATES) -> DataFrame:
    """Fit all cities (or those in ``only``), score them, and promote where the error fell.

    Models and scores lie under their version: training a version again replaces it.
    """
    features = spark.read.parquet(at.features)
    if only is not None:
        features = lookups.known(features, only, KEYS)
    model = _model(features, regressors)
    rows = metrics.split_by_time(features, KEYS, test_days=test_days).select(
        "city", "ds", "y", "split", *model.regressors)
    saved = f"{at.models}/version={version}"
    regression.fit(rows.filter("split = 'train'"), KEYS, model=model).write.mode("overwrite").parquet(saved)
    scored = regression.predict(rows, spark.read.parquet(saved), KEYS, model=model)
    both = metrics.split_metrics(scored, KEYS).join(metrics.evaluate(scored.filter("split = 'test'"), KEYS).select(
        "city", "category_accuracy", "coverage_95", "boundary_error_rate"), KEYS, "left")
    (both.withColumn("mae", F.col("test_mae")).withColumn("trained_at", _moment(trained_at))
     .write.mode("overwrite").parquet(f"{at.versions}/version={version}"))
    return registry.champion_history(spark.read.parquet(at.versions), KEYS)


def score_baselines(spark: SparkSession, at: Layout, test_days: int = 7) -> DataFrame:
    """Errors of the statistical baselines on the last days, a row for each city and baseline, beside its champion's.

    The autoregressive baseline looks all the test days ahead from the rows before them, the
    seasonal-naive one a day ahead at a time. ``improvement_pct`` is what the champion gains on the baseline; null without a champion.
    """
    rows = saved(metrics.split_by_time(spark.read.parquet(at.features).select("city", "ds", "y"), KEYS, test_days=test_days), "series")
    past, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    # a day more than the test days, as the rows before them may end early
    ahead = autoregression.predict(past, autoregression.fit(past, KEYS), KEYS, steps=(test_days + 1) * 24)
    forecasts = {"autoregressive": test.join(ahead, ["city", "ds"]),
                 "seasonal_naive": forecast.seasonal_naive(rows, KEYS).filter("split = 'test'")}
    parts = [metrics.evaluate(scored, KEYS).select("city", F.lit(name).alias("baseline"), "mae", "rmse", "mape_clip", "coverage_95")
             for name, scored in forecasts.items()]
    scores = parts[0].unionByName(parts[1])
    if stores.exists(spark, at.versions):
        found = registry.champion_history(spark.read.parquet(at.versions), KEYS).filter("status = 'champion'")
        scores = scores.join(found.select("city", F.col("mae").alias("model_mae")), KEYS, "left")
    else:
        scores = scores.withColumn("model_mae", F.lit(None).cast("double"))
    scores.withColumn("improvement_pct", F.try_divide(F.col("mae") - F.col("model_mae"), F.col("mae")) * 100).write.mode(
        "overwrite").parquet(at.baseline_scores)
    return spark.read.parquet(at.baseline_scores)


def champion_models(spark: SparkSession, at: Layout) -> DataFrame:
    """The fitted parameters of each city's champion."""
    found = registry.champion_history(spark.read.parquet(at.versions), KEYS).filter("status = 'champion'")
    models = spark.read.option("mergeSchema", "true").parquet(at.models)  # shapes differ between versions
    return models.join(found.select("city", "version"), ["city", "version"], "left_semi").drop("version")


def evaluate(spark: SparkSession, at: Layout, as_of: str, test_days: int = 30) -> DataFrame:
    """Champion models on the last days; written as JSON and CSV reports."""
    features = spark.read.parquet(at.features)
    test = metrics.split_by_time(features, KEYS, test_days=test_days, min_test_rows=24).filter("split = 'test'")
    scored = _predicted(champion_models(spark, at), lambda model: regression.assemble_regressors(
        test, KEYS, "ds", model.regressors))
    scored = saved(scored.join(test.select("city", "ds", "y"), ["city", "ds"]), "scored")  # the report reads it many times
    report = metrics.evaluation_report(scored, KEYS)
    stores.write_report(report, at.reports, as_of)
    return spark.read.schema(report.schema).json(f"{at.reports}/evaluation_latest.json")


def forecast_next(spark: SparkSession, at: Layout, as_of: str, horizon: int = 24,
                  live: DataFrame | None = None) -> DataFrame:
    """The next hours of every city that has a champion.

    ``live`` (city, value) is the current index where a live source answered.
    """
    moment = _moment(as_of)
    champions = champion_models(spark, at)
    past = hourly_readings(spark, at, until=as_of).filter(F.col("ts") <= moment)
    wx = hourly_weather(spark, at)
    means = lookups.recent_mean(wx.filter(F.col("ts") <= moment), KEYS, "ts",
                                [c for c in wx.columns if c in WEATHER_COLS])
    recent = lookups.recent_mean(past, KEYS, "ts", ["aqi"]).withColumnRenamed("aqi", "value")
    last = lookups.last_known(past, KEYS, "ts", ["aqi"]).withColumnRenamed("aqi", "value")
    live = recent.filter(F.lit(False)) if live is None else live
    current = lookups.fallback_value(champions.select("city"), live, last, recent, KEYS)
    scored = _predicted(champions, lambda model: forecast.future_frame(
        champions.select("city"), KEYS, moment, horizon, wx, means, current, recent, model.regressors))
    return forecast.forecast_output(scored, KEYS)
