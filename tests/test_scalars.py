"""Index, categories, calendar and time functions at their edges."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourgrid import dimensions as dim
from hourgrid.functions import index as ix
from hourgrid.functions import timefns as tf


def one(spark, value, dtype, *exprs):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(*[e(F.col("x")) for e in exprs]).first()


@pytest.mark.parametrize("pm25, expected", [
    (-1.0, 0), (0.0, 0), (12.0, 50), (12.05, 500), (12.1, 51), (35.4, 100), (35.45, 500), (55.4, 150),
    (55.5, 151), (150.4, 200), (150.45, 500), (150.5, 201), (250.5, 301), (500.4, 500), (501.0, 500), (None, None)])
def test_index(spark, pm25, expected):
    assert one(spark, pm25, "double", ix.pm25_to_aqi)[0] == expected


@pytest.mark.parametrize("pm25, expected", [(12.05, 50), (35.45, 100), (150.45, 200), (500.45, 500)])
def test_index_without_gaps(spark, pm25, expected):
    assert one(spark, pm25, "double", lambda c: ix.pm25_to_aqi(c, gap="truncate"))[0] == expected


def test_index_rounds_half_to_even(spark):
    got = one(spark, 2.5, "double", ix.whole_index)[0], one(spark, 3.5, "double", ix.whole_index)[0]
    assert got == (2, 4)


@pytest.mark.parametrize("aqi, label", [
    (25, "Good"), (50, "Good"), (51, "Satisfactory"), (75, "Satisfactory"), (100, "Satisfactory"),
    (101, "Moderate"), (150, "Moderate"), (200, "Moderate"), (201, "Poor"), (250, "Poor"), (300, "Poor"),
    (301, "Very Poor"), (350, "Very Poor"), (400, "Very Poor"), (401, "Severe"), (450, "Severe"),
    (500, "Severe"), (501, "Severe"), (-1, "Severe")])
def test_category_bands(spark, aqi, label):
    got = one(spark, aqi, "int", ix.aqi_category)[0]
    assert got["label"] == label and set(got.asDict()) == {"label", "color", "advice"}


def test_category_cuts_fractions_display_does_not(spark):
    label, color = one(spark, 50.5, "double", ix.aqi_label, ix.display_color)
    assert (label, color) == ("Good", "#92d050")


@pytest.mark.parametrize("start, crop, festival", [
    ("2024-10-01", 1.0, 0.55), ("2024-11-01", 1.0, 0.50), ("2024-07-01", 0.0, 0.0), ("2024-03-01", 0.0, 0.0)])
def test_season_effects(spark, start, crop, festival):
    hours = spark.sql(f"SELECT explode(sequence(TIMESTAMP_NTZ'{start} 00:00:00',"
                      f" TIMESTAMP_NTZ'{start} 23:00:00', INTERVAL 1 HOUR)) AS ds")
    got = tf.with_season_effects(hours).collect()
    assert len(got) == 24
    assert {(r.crop_burning, r.festival_period) for r in got} == {(crop, festival)}


def test_calendar_and_cyclic(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-01-01 00:00:00',"
                   " TIMESTAMP_NTZ'2024-01-14 23:00:00', INTERVAL 1 HOUR)) AS ds")
    for r in tf.with_cyclic(tf.with_calendar(df)).collect():
        assert (r.hour, r.dayofweek, r.month) == (r.ds.hour, r.ds.weekday(), r.ds.month)
        assert r.is_weekend == int(r.ds.weekday() >= 5)
        assert r.is_rush_hour == int(r.ds.hour in (7, 8, 9, 10, 17, 18, 19, 20))
        assert r.dow_sin == pytest.approx(math.sin(2 * math.pi * r.dayofweek / 7))
        assert all(-1 <= r[c] <= 1 for c in ("hour_sin", "hour_cos", "dow_cos", "month_sin", "month_cos"))


def test_time_zones_and_labels(rows):
    df = rows([("2024-01-01 00:00:00",)], "t string", ["t"])
    t = F.col("t")
    got = df.select(tf.local_to_utc(t), tf.utc_to_local(t), tf.local_iso(t), tf.local_label(t), tf.date_key(t)).first()
    assert tuple(got) == (datetime(2023, 12, 31, 18, 30), datetime(2024, 1, 1, 5, 30), "2024-01-01T05:30:00+05:30",
                          "01 Jan 05:30 IST", "2024-01-01")


@pytest.mark.parametrize("text, offset, expected", [
    ("2024-01-01 12:00:00", "+05:30", datetime(2024, 1, 1, 6, 30)),
    ("2024-01-01 12:00:00", "+00:00", datetime(2024, 1, 1, 12)),
    ("2024-01-01 12:00:00", None, datetime(2024, 1, 1, 6, 30)),
    ("garbled", "+05:30", datetime(2030, 1, 1))])
def test_parse_offset(spark, text, offset, expected):
    df = spark.createDataFrame([(text, offset)], "s string, z string")
    assert df.select(tf.parse_offset_timestamp(F.col("s"), F.col("z"), F.lit("2030-01-01 00:00:00"))).first()[0] == expected


def test_parsing_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-01-01 12:00:00", "+05:30")], "s string, z string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = df.select(tf.parse_offset_timestamp(F.col("s"), F.col("z"), F.lit("2030-01-01 00:00:00"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == datetime(2024, 1, 1, 6, 30)


def test_hour_number_round_trip(rows):
    df = rows([("2024-02-29 17:00:00",), ("1969-12-31 23:00:00",)], "t string", ["t"])
    back = df.select("t", tf.hour_start(tf.hour_number(F.col("t"))).alias("b")).collect()
    assert all(r.t == r.b for r in back)


def test_city_dimension(spark):
    cities = dim.cities(spark).collect()
    assert len(cities) == 5
    assert all(8 <= c.lat <= 37 and 68 <= c.lon <= 97 and c.timezone == "Asia/Kolkata" for c in cities)
    assert all(len(c.station_ids) == len(set(c.station_ids)) > 0 for c in cities)
    assert all(a[1] < b[0] for a, b in zip(dim.PM25_BREAKPOINTS, dim.PM25_BREAKPOINTS[1:]))
