"""Payload parsers, history files, stores and reports."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hourgrid.operators import quality
from hourgrid.sources import baselines, feeds, history, quarantine, stores
from hourgrid.sources.schemas import RAW_READING


def pages(spark, *payloads):
    return spark.createDataFrame([("c", json.dumps(p) if not isinstance(p, str) else p) for p in payloads],
                                 "city string, payload string")


def record(value=10.0, utc="2024-01-01T05:30:00Z", coverage=100.0, flagged=False, **extra):
    out = {"value": value, "coverage": {"percentCoverage": coverage}, "flagInfo": {"hasFlags": flagged},
           "summary": {"min": 1.0, "max": 20.0, "sd": 2.0}, **extra}
    if utc is not None:
        out["period"] = {"datetimeTo": {"utc": utc}}
    return out


@pytest.mark.parametrize("bad", [
    record(coverage=49.0), record(flagged=True), record(value=None), record(utc=None), record(utc="garbled"),
    record(value=-1.0), record(value=1000.0)])
def test_unusable_measurements_are_dropped(spark, bad):
    got = feeds.measurements(pages(spark, {"results": [record(), bad]}), ["city"], "payload").collect()
    assert [(r.ts, r.pm25) for r in got] == [(datetime(2024, 1, 1, 5), 10.0)]


def test_measurement_defaults_and_hourly(spark):
    bare = {"value": 20.0, "period": {"datetimeTo": {"utc": "2024-01-01T05:59:00Z"}}}
    half = record(coverage=50.0)
    got = feeds.measurements_hourly(pages(spark, {"results": [half, bare]}, "not json"), ["city"], "payload").collect()
    assert len(got) == 1
    r = got[0]
    assert (r.ts, r.pm25, r.pm25_min, r.pm25_max, r.pm25_sd, r.coverage_pct, r.aqi) == (
        datetime(2024, 1, 1, 5), 15.0, 1.0, 20.0, 2.0, 75.0, 57)


def test_sensors(spark):
    listed = {"results": [{"id": 5, "parameter": {"name": "PM25"}}, {"id": 9, "parameter": {"name": "no2"}}]}
    got = feeds.sensors(pages(spark, listed), ["city"], "payload").orderBy("position").collect()
    assert [(r.position, r.sensor, r.parameter) for r in got] == [(0, 5, "PM25"), (1, 9, "no2")]


def test_weather_arrays(spark):
    body = {"hourly": {"time": ["2024-01-01T05:30", "2024-01-01T06:30", "2024-01-01T07:30"],
                       "temperature_2m": [20.0, None, 22.0], "wind_speed_10m": [1.0, 2.0, 3.0]}}
    got = feeds.weather_arrays(pages(spark, body, {}, {"hourly": {}}), ["city"], "payload").orderBy("ts").collect()
    assert [(r.ts, r.temperature_2m, r.wind_speed_10m, r.precipitation) for r in got] == [
        (datetime(2024, 1, 1, 0), 20.0, 1.0, None), (datetime(2024, 1, 1, 2), 22.0, 3.0, None)]


def test_live_readings(spark):
    good = {"status": "ok", "data": {"aqi": 88, "time": {"s": "2024-01-01 12:00:00"}, "iaqi": {"t": {"v": 21.5}}}}
    got = feeds.live_readings(pages(
        spark, good, {"status": "error", "data": {"aqi": 5}}, {"status": "ok", "data": {"time": {"s": "2024-01-01 12:00:00"}}}),
        ["city"], "payload", F.lit("2030-01-01 00:00:00")).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.ts, r.aqi, r.temperature, r.humidity, r.pm25, r.location_id, r.source, r.coverage_pct) == (
        datetime(2024, 1, 1, 6, 30), 88, 21.5, None, 88.0, -1, "live", 100.0)


CSV = """Datetime,City,PM2_5_ugm3,Temp_2m_C,Wind_Speed_10m_kmh,Wind_Dir_10m,Humidity_Percent,Precipitation_mm,Pressure_MSL_hPa,Season
2024-01-01 00:10:00, New Delhi ,12.0,20,36,180,50,0,1010,Winter
2024-01-01 00:40:00,DELHI,35.4,21,36,180,50,0,1010,Winter
2024-01-01 01:00:00,delhi,-1,22,72,180,50,0,x,Winter
2024-01-01 02:00:00,delhi,1000,22,72,180,50,0,1011,Winter
not a date,delhi,5,22,72,180,50,0,1011,Winter
2024-01-01 03:00:00,Calcutta,n/a,22,72,180,50,0,1011,Winter
2024-01-01 03:00:00,Atlantis,5,22,72,180,50,0,1011,Winter
"""


def test_history(spark, tmp_path):
    (tmp_path / "h.csv").write_text(CSV)
    df = history.read_history(spark, str(tmp_path / "h.csv"))
    got = history.readings(df, order=["PM2_5_ugm3"]).collect()
    assert [(r.city, r.timestamp, r.pm25, r.aqi, r.location_id, r.pm25_sd) for r in got] == [
        ("Delhi", datetime(2024, 1, 1), 12.0, 50, 0, 0.0)]
    wx = history.weather(df).orderBy("city", "timestamp").collect()
    assert [(r.city, r.timestamp.hour, r.temperature_2m, r.wind_speed_10m, r.surface_pressure, r.season) for r in wx] == [
        ("Delhi", 0, 20.0, 10.0, 1010.0, "Winter"), ("Delhi", 1, 22.0, 20.0, None, "Winter"),
        ("Delhi", 2, 22.0, 20.0, 1011.0, "Winter"), ("Kolkata", 3, 22.0, 20.0, 1011.0, "Winter")]


def test_history_warns_on_missing_columns(spark, tmp_path):
    (tmp_path / "h.csv").write_text("Datetime,City,PM2_5_ugm3\n2024-01-01 00:00:00,Delhi,10\n")
    with pytest.warns(UserWarning, match="Temp_2m_C"):
        df = history.read_history(spark, str(tmp_path / "h.csv"))
    assert history.readings(df).count() == 1
    assert history.weather(df).first().temperature_2m is None


def test_store_upsert_is_first_wins_and_idempotent(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    first = rows([("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-02 00:00:00", 2.0)], "city string, ts string, v double", ["ts"])
    second = rows([("a", "2024-01-02 00:00:00", 9.0), ("a", "2024-01-02 01:00:00", 3.0), ("b", "2024-01-03 00:00:00", 4.0)],
                  "city string, ts string, v double", ["ts"])
    want = [("a", datetime(2024, 1, 1), 1.0), ("a", datetime(2024, 1, 2), 2.0),
            ("a", datetime(2024, 1, 2, 1), 3.0), ("b", datetime(2024, 1, 3), 4.0)]
    for batch in (first, second, second, first):
        stores.upsert_days(spark, path, batch, ["city"], "ts", [F.col("v")])
    assert sorted((r.city, r.ts, r.v) for r in spark.read.parquet(path).collect()) == want
    assert (tmp_path / "store" / "city=a" / "date=2024-01-02").is_dir()


def test_store_keys_stay_text(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    batch = rows([(c, "2024-01-01 00:00:00", 1.0) for c in ("007", "1e3", "2024-01-01", "true", "7")],
                 "city string, ts string, v double", ["ts"])
    for _ in range(2):
        stores.upsert_days(spark, path, batch, ["city"], "ts", [F.col("v")])
    assert sorted(r.city for r in stores.read_store(spark, path).collect()) == ["007", "1e3", "2024-01-01", "7", "true"]


def test_store_survives_a_cut_short_swap(spark, rows, tmp_path):
    """The days are staged, then a day's folder vanishes before its new files are in place."""
    import shutil

    path, schema = str(tmp_path / "store"), "city string, ts string, v double"
    stores.upsert_days(spark, path, rows([("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-02 00:00:00", 2.0)], schema, ["ts"]),
                       ["city"], "ts", [F.col("v")])
    batch = rows([("a", "2024-01-02 05:00:00", 5.0)], schema, ["ts"])
    whole = stores._swap
    try:
        stores._swap = lambda *_: (_ for _ in ()).throw(RuntimeError("killed"))
        with pytest.raises(RuntimeError):
            stores.upsert_days(spark, path, batch, ["city"], "ts", [F.col("v")])
    finally:
        stores._swap = whole
    shutil.rmtree(f"{path}/city=a/date=2024-01-02")
    stores.upsert_days(spark, path, batch, ["city"], "ts", [F.col("v")])
    assert sorted(r.v for r in stores.read_store(spark, path).collect()) == [1.0, 2.0, 5.0]


def test_store_reads_only_touched_days(spark, rows, tmp_path):
    path, schema = str(tmp_path / "store"), "city string, ts string, v double"
    days = [("a", f"2024-01-{d:02} 00:00:00", float(d)) for d in range(1, 10)]
    stores.upsert_days(spark, path, rows(days, schema, ["ts"]), ["city"], "ts", [F.col("v")])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    stores.upsert_days(spark, path, rows([("a", "2024-01-01 07:00:00", 0.5), ("a", "2024-01-09 07:00:00", 0.5)], schema, ["ts"]),
                       ["city"], "ts", [F.col("v")])
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    assert sum(before.get(p) == m for p, m in after.items()) == 7 and len(after) == 9


def test_store_scan_prunes_days_and_columns(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    stores.upsert_days(spark, path, rows([("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-02 00:00:00", 2.0)],
                                         "city string, ts string, v double", ["ts"]), ["city"], "ts", [F.col("v")])
    scan = stores.read_store(spark, path).filter(F.col("date") == F.lit(date(2024, 1, 2))).select("v")
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text and "ReadSchema: struct<v:double>" in text
    assert scan.collect()[0].v == 2.0


def test_report_files(spark, tmp_path):
    df = spark.createDataFrame([("c", 1.5, [(1, 0.5)])], "city string, mae double, bins array<struct<bin:int,low:double>>")
    stores.write_report(df, str(tmp_path), "2024-01-31 00:00:00")
    assert {p.name for p in tmp_path.iterdir()} == {
        "evaluation_20240131_000000.json", "evaluation_20240131_000000.csv", "evaluation_latest.json", "evaluation_latest.csv"}
    back = spark.read.json(str(tmp_path / "evaluation_latest.json")).first()
    assert back.bins[0].low == 0.5 and back.generated_at == "2024-01-31 00:00:00"
    text = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "evaluation_latest.csv")).first().bins
    assert json.loads(text) == [{"bin": 1, "low": 0.5}]


def test_raw_schema_reads_missing_columns_as_null(spark, tmp_path):
    spark.createDataFrame([(10.0, "c")], "pm25 double, city string").write.parquet(str(tmp_path / "raw"))
    r = stores.read_store(spark, str(tmp_path / "raw"), RAW_READING).first()
    assert (r.pm25, r.city, r.location_id, r.timestamp) == (10.0, "c", None, None)


def test_quality_helpers(spark):
    df = spark.createDataFrame([("c", 1.0, None), ("c", float("nan"), 2.0)], "city string, a double, b double")
    assert [r[0] for r in df.select(quality.nan_to_null(F.col("a"))).collect()] == [1.0, None]
    assert quality.missing_columns(df, ["a", "z"]) == ["z"]
    assert quality.keep_present(df, ["b", "z", "a"]).columns == ["b", "a"]
    filled = quality.fill_with_series_mean(df, ["city"], ["b"], 0.0).collect()
    assert {r.b for r in filled} == {2.0}
    slow = spark.createDataFrame([("a", 20.0), ("a", 12.0), ("b", 2.0)], "city string, wind_speed_10m double")
    fixed = {(r.city, round(r.wind_speed_10m, 6)) for r in quality.wind_unit_fix(slow, ["city"]).collect()}
    assert fixed == {("a", round(20 / 3.6, 6)), ("a", round(12 / 3.6, 6)), ("b", 2.0)}


def test_stored_baselines_prune_to_the_month(spark, tmp_path):
    """A month is one folder a series; series without enough rows in it fall back to all of theirs."""
    rows = spark.range(24 * 90).selectExpr(
        "if(id % 7 < 5, 'full', 'thin') AS city", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id AS int)) AS ds",
        "cast(id % 100 AS double) AS y").filter("city = 'full' OR day(ds) <= 8")
    path = str(tmp_path / "baselines")
    baselines.write_baselines(rows, path, ["city"], min_rows=100)
    found = baselines.read_baselines(spark, path, ["city"], 2)
    got = {(r.city, r.month): r["count"] for r in found.groupBy("city", "month").count().collect()}
    assert set(got) == {("full", 2), ("thin", 1), ("thin", 2), ("thin", 3)}
    assert baselines.read_baselines(spark, path, ["city"]).count() == rows.count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("PartitionFilters: ")[1:]]
    assert any("(month#" in f.split("PushedFilters")[0] and "= 2)" in f.split("PushedFilters")[0] for f in filters)
    assert any("dynamicpruning" in f.split("PushedFilters")[0] for f in filters)


def test_ordered_files(spark, tmp_path):
    path = str(tmp_path / "ordered")
    stores.write_ordered(spark.range(5000).selectExpr("(id * 7919) % 5000 AS id"), path, ["id"], files=4)
    rows = stores.read_positions(spark, path)
    assert rows.count() == 5000 and rows.filter("position != id + 1").count() == 0
    assert len(list((tmp_path / "ordered").glob("*.parquet"))) == 4


def test_every_record_is_in_one_table(spark, tmp_path):
    good = '{"value": 5.0, "period": {"datetimeTo": {"utc": "2024-01-01T05:30:00Z"}}}'
    pages = [(f'{{"results": [{good}, {{"value": "x"}}, 7, {{"value": -1, "period": {{"datetimeTo": {{"utc": "2024-01-01T05:30:00Z"}}}}}}]}}',),
             ("{broken",), (None,), ('{"results": []}',), ('{"results": [{"value": 1.0}]}',)]
    judged = quarantine.judged_measurements(spark.createDataFrame(pages, "payload string").selectExpr("'c' AS city", "payload"), ["city"], "payload")
    usable, rejected = str(tmp_path / "u"), str(tmp_path / "r")
    quarantine.apart(judged, usable, rejected)
    assert [(r.pm25, r.ts.hour) for r in spark.read.parquet(usable).collect()] == [(5.0, 5)]
    reasons = sorted(r.reason for r in spark.read.parquet(rejected).collect())
    assert reasons == sorted(["unreadable record", "unreadable record", "out of bounds", "unreadable payload", "unreadable payload", "no time"])
