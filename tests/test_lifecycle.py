"""The whole way from landed files to a forecast, on tables derived from the given events."""

import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from hourgrid.functions import sql as sql_functions
from hourgrid.functions.index import pm25_to_aqi
from hourgrid.plans import lifecycle as life

AS_OF = "2024-01-30 12:00:00"
NAMES = {"error": "Delhi", "click": "Mumbai", "view": "Kolkata", "signup": "Chennai", "purchase": "Bengaluru"}


@pytest.fixture(scope="module")
def landed(spark):
    """Measurement and weather pages made from the events."""
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    names = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    rows = events.select(names[F.col("event_type")].alias("city"), F.col("user_id").alias("location_id"), "ts", "value")
    record = F.struct(F.col("value"), F.struct(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc"))
                                               .alias("datetimeTo")).alias("period"))
    pages = rows.select("city", "location_id", "ts", F.to_json(F.struct(F.array(record).alias("results"))).alias("payload"))
    hour = F.struct(F.date_format(F.col("ts") + F.expr("INTERVAL 330 MINUTES"), "yyyy-MM-dd'T'HH:mm").alias("time"),
                    (20 + F.hour("ts") * 0.5).alias("t"), (F.hour("ts") * 2.0).alias("w"))
    days = (rows.select("city", F.date_trunc("hour", "ts").alias("ts")).distinct()
            .groupBy("city", F.to_date("ts")).agg(F.collect_list(hour).alias("h")))
    weather = days.select("city", F.to_json(F.struct(F.struct(
        F.col("h.time").alias("time"), F.col("h.t").alias("temperature_2m"), F.col("h.w").alias("wind_speed_10m"))
        .alias("hourly"))).alias("payload"))
    return pages, weather


def test_whole_way(spark, landed, tmp_path):
    pages, weather = landed
    at = life.Layout(str(tmp_path))
    early = F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    for part in (pages.filter(early), pages.filter(~early), pages.filter(early)):
        life.ingest_measurements(spark, at, part)
    life.ingest_weather(spark, at, weather)
    hours = pages.select("city", F.date_trunc("hour", "ts")).distinct().count()
    assert spark.read.parquet(at.readings).count() == hours

    life.build_features(spark, at)
    features = spark.read.parquet(at.features)
    assert features.count() == hours and features.filter("temperature_2m IS NULL OR aqi_lag_168h IS NULL").count() == 0
    assert spark.read.parquet(f"{at.baseline}/rows").count() == hours
    assert {r.city for r in spark.read.json(at.stats).collect()} == set(NAMES.values())

    drifted = life.check_drift(spark, at, AS_OF).collect()
    assert len(drifted) == 5 and all(r.error is None and 0 <= r.p_value <= 1 and r.recent_n >= 24 for r in drifted)

    # checks read the stored baselines, of January where there is one: the features may be gone
    blind = replace(at, root=str(tmp_path / "blind"))
    for name in ("baseline/rows", "baseline/months", "readings", "readings.store"):
        shutil.copytree(f"{at.root}/{name}", f"{blind.root}/{name}")
    seasonal = life.check_drift(spark, blind, AS_OF, seasonal=True).collect()
    assert sorted((r.city, r.p_value, r.ks_stat) for r in seasonal) == sorted((r.city, r.p_value, r.ks_stat) for r in drifted)
    assert {r.baseline_type for r in seasonal} == {"seasonal"}

    life.train(spark, at, 1, AS_OF, test_days=10)
    history = life.train(spark, at, 2, AS_OF, only=spark.createDataFrame([("Delhi",)], "city string"), test_days=5,
                         regressors=("temperature_2m", "crop_burning", "surface_pressure")).collect()
    assert sorted((r.city, r.version) for r in history) == sorted([(c, 1) for c in NAMES.values()] + [("Delhi", 2)])
    assert life.champion_models(spark, at).count() == 5
    shapes = {v: spark.read.parquet(f"{at.models}/version={v}").first().shape for v in (1, 2)}
    assert '"crop_burning", "festival_period"' in shapes[1] and "humidity" not in shapes[1]  # humidity has no values
    assert '["temperature_2m", "crop_burning"]' in shapes[2]
    # as if the newer model were Delhi's champion: two shapes side by side
    (spark.read.parquet(f"{at.versions}/version=2").withColumn("mae", F.lit(0.0)).withColumn("test_mae", F.lit(0.0))
     .write.parquet(str(tmp_path / "better")))
    spark.read.parquet(str(tmp_path / "better")).write.mode("overwrite").parquet(f"{at.versions}/version=2")
    assert life.champion_models(spark, at).select("shape").distinct().count() == 2

    report = life.evaluate(spark, at, AS_OF, test_days=10).collect()
    assert len(report) == 5 and all(len(r.calibration_bins) == 5 and r.mae > 0 and r.test_rows >= 24 for r in report)

    live = spark.createDataFrame([("Delhi", 321.0)], "city string, value double")
    out = life.forecast_next(spark, at, AS_OF, 24, live).collect()
    assert len(out) == 5 * 24
    assert all(0 <= r.aqi_lower <= r.aqi <= r.aqi_upper <= 500 for r in out)
    assert all(r.category.label in {"Good", "Satisfactory", "Moderate", "Poor", "Very Poor", "Severe"} for r in out)
    assert {r.timestamp for r in out if r.city == "Delhi"} == {f"2024-01-{30 + (12 + h) // 24}T{(12 + h) % 24:02d}:00:00" for h in range(24)}


def test_history_and_live_share_the_store(spark, tmp_path):
    at = life.Layout(str(tmp_path / "root"))
    (tmp_path / "h.csv").write_text(
        "Datetime,City,PM2_5_ugm3,Temp_2m_C,Wind_Speed_10m_kmh,Wind_Dir_10m,Humidity_Percent,Precipitation_mm,Pressure_MSL_hPa\n"
        "2024-01-01 00:00:00,Delhi,12.0,20,36,180,50,0,1010\n")
    life.ingest_history(spark, at, str(tmp_path / "h.csv"))
    payload = '{"status":"ok","data":{"aqi":77,"time":{"s":"2024-01-01 07:12:00"}}}'
    life.ingest_live(spark, at, spark.createDataFrame([("Delhi", payload)], "city string, payload string"), AS_OF)
    got = life.hourly_readings(spark, at).orderBy("ts").collect()
    assert [(r.ts.hour, r.aqi) for r in got] == [(0, 50), (1, 77)]
    assert life.hourly_weather(spark, at).first().wind_speed_10m == 10.0


def test_sql_functions(spark):
    sql_functions.register(spark)
    df = spark.sql("SELECT id / 7.0D - 3 AS v FROM range(4000)")
    both = df.select("v", pm25_to_aqi(F.col("v")).alias("a")).selectExpr("a", "pm25_to_aqi(v) AS b", "aqi_category(a).label AS l")
    assert both.filter("NOT (a <=> b)").count() == 0 and both.select("l").distinct().count() == 6


def test_no_champion_no_rows(spark):
    none = spark.createDataFrame([], "city string, shape string")
    got = life._predicted(none, lambda model: none)
    assert got.columns == ["city", "ds", "yhat", "yhat_lower", "yhat_upper"] and got.count() == 0
