"""As-of values, fallbacks, stations, backfills and alert rules."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourgrid.operators import alerts, backfill, lookups, stations

T0 = datetime(2024, 1, 1)


def at(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize("bucket_hours, rows_per_task", [(1, 1), (24, 4), (100_000, 50), (100_000, 10_000)])
def test_as_of_join_equals_pandas(spark, bucket_hours, rows_per_task):
    rng = np.random.default_rng(11)
    frame = lambda n, name: pd.DataFrame({
        "city": rng.choice(["a", "b"], n, p=[0.9, 0.1]),
        "ts": [T0 + timedelta(minutes=int(m)) for m in rng.choice(60 * 24 * 30, n, replace=False)], name: np.arange(n)})
    left, right = frame(400, "l"), frame(60, "r")
    to = lambda pdf: spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = lookups.as_of_join(to(left), to(right), ["city"], "ts", ["r"], bucket_hours, rows_per_task).toPandas().sort_values("l")
    want = pd.merge_asof(left.sort_values("ts"), right.sort_values("ts"), on="ts", by="city").sort_values("l")
    np.testing.assert_array_equal(got.r.to_numpy(float), want.r.to_numpy(float))
    assert got.matched_ts.notna().sum() == want.r.notna().sum() > 0


def test_last_known_and_recent_days(rows):
    df = rows([("a", f"2024-01-{d:02d} 10:00:00", d) for d in range(1, 12) if d != 8] + [("a", "2024-01-11 12:00:00", 99)],
              "city string, ts string, v int", ["ts"])
    assert lookups.last_known(df, ["city"], "ts", ["v"], at("2024-01-09 09:00:00")).first().v == 7
    assert lookups.last_known(df, ["city"], "ts", ["v"]).first().v == 99
    assert sorted(r.v for r in lookups.recent_days(df, ["city"], "ts").collect()) == [4, 5, 6, 7, 9, 10, 11, 99]


def test_fallback_order(spark):
    one = lambda *pairs: spark.createDataFrame(list(pairs), "city string, value double")
    got = lookups.fallback_value(
        spark.createDataFrame([(c,) for c in "abcd"], "city string"), one(("a", 1.0)), one(("a", 2.0), ("b", 2.0)),
        one(("a", 3.0), ("b", 3.0), ("c", 3.0)), ["city"]).orderBy("city").collect()
    assert [(r.value, r.source) for r in got] == [(1.0, "live"), (2.0, "last_known"), (3.0, "recent_mean"), (100.0, "default")]


def test_boxes_equal_all_pairs(spark):
    rng = np.random.default_rng(2)
    places = [("p%d" % i, float(a), float(b)) for i, (a, b) in enumerate(rng.uniform(-3, 3, (12, 2)))]
    located = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.uniform(-3, 3, (300, 2)))]
    located.append((999, places[0][1] + 0.5, places[0][2] - 0.5))
    got = stations.stations_in_boxes(spark.createDataFrame(places, "city string, lat double, lon double"),
                                     spark.createDataFrame(located, "station int, station_lat double, station_lon double"))
    want = {(p, s) for p, la, lo in places for s, x, y in located
            if la - 0.5 <= x <= la + 0.5 and lo - 0.5 <= y <= lo + 0.5}
    pairs = [(r.city, r.station) for r in got.collect()]
    assert set(pairs) == want and len(pairs) == len(want)


def test_sensors_and_consensus(spark, rows):
    readings = rows([(1, 5, "2023-06-01 00:00:00"), (1, 7, "2024-02-01 00:00:00"), (1, 9, "2025-01-01 00:00:00"), (2, 3, "2020-01-01 00:00:00")],
                    "loc int, sensor int, ts string", ["ts"])
    assert [(r["loc"], r.sensor) for r in stations.first_live_sensor(readings, "loc", "sensor", "ts").collect()] == [(1, 7)]
    assert {r["loc"]: r.sensor for r in stations.active_sensor(readings, "loc", "sensor").collect()} == {1: 9, 2: 3}
    values = spark.createDataFrame([("c", 1, 90), ("c", 2, 100), ("c", 3, 110), ("c", 4, 500), ("c", 5, 0)], "city string, station int, aqi int")
    r = stations.consensus(values, ["city"], "station", "aqi").first()
    assert (r.median_aqi, r.stations_used, r.aqi_range, r.nearest_station) == (110, 4, "90-500", 3)


def test_backfill_requests(rows):
    requests = rows([(1, "2024-01-01", "2024-03-01"), (2, "2024-03-01", "2024-01-01"), (3, "2020-01-01", "2024-01-01"),
                     (4, None, "2024-01-01"), (5, "2024-04-01", None)], "id int, date_from string, date_to string", ["date_from", "date_to"])
    got = {r.id: r for r in backfill.validate_requests(requests, as_of=at("2024-05-01")).collect()}
    assert [got[i].valid for i in range(1, 6)] == [True, False, False, False, True]
    assert got[3].reason == "date range too large: 1461 days (max 730)" and got[5].days == 30
    valid = backfill.validate_requests(requests, as_of=at("2024-05-01")).filter("valid")
    chunks = backfill.chunk_requests(valid).orderBy("id", "chunk_from").collect()
    assert [(c.id, c.chunk_from.date().isoformat(), c.chunk_to.date().isoformat()) for c in chunks] == [
        (1, "2024-01-01", "2024-01-31"), (1, "2024-01-31", "2024-03-01"), (5, "2024-04-01", "2024-05-01")]


def events(rows, *offsets):
    stamps = [("s", (T0 + timedelta(seconds=s)).isoformat(sep=" "), v) for s, v in offsets]
    return rows(stamps, "service string, ts string, latency double", ["ts"])


def test_rates_and_ratios(rows):
    df = events(rows, (0, 1.0), (59, 100.0), (60, 1.0), (130, 1.0))
    rate = {r.eval_ts: r.requests for r in alerts.request_rate(df, ["service"]).collect()}
    assert rate == {T0 + timedelta(minutes=1): 2, T0 + timedelta(minutes=2): 1, T0 + timedelta(minutes=3): 1}
    ratio = {r.eval_ts: (r.requests, r.failed) for r in alerts.error_ratio(df, ["service"], F.col("latency") > 50).collect()}
    assert ratio[T0 + timedelta(minutes=1)] == (2, 1) and ratio[T0 + timedelta(minutes=3)] == (4, 1)
    assert ratio[T0 + timedelta(minutes=7)] == (1, 0) and len(ratio) == 7


def test_histogram_quantile(rows):
    df = events(rows, *[(i, v) for i, v in enumerate([0.05] * 10 + [0.3] * 80 + [7.0] * 10)])
    q = alerts.histogram_quantile(df, ["service"], "latency", step=300).first()
    assert q.requests == 100 and q.quantile == pytest.approx(5.0 + 5.0 * (95 - 90) / 10)
    top = alerts.histogram_quantile(events(rows, (0, 9999.0)), ["service"], "latency", step=300).first()
    assert top.quantile is None and (top.requests, top.overflow, q.overflow) == (1, 1, 0)


def test_sustained_runs(rows, spark):
    minutes = [1, 2, 3, 4, 5, 6, 9, 10, 20]
    df = spark.createDataFrame([("s", (T0 + timedelta(minutes=m)).isoformat(sep=" "), m != 10) for m in minutes],
                               "service string, eval_ts string, on boolean").withColumn("eval_ts", F.col("eval_ts").cast("timestamp_ntz"))
    got = alerts.sustained(df, ["service"], F.col("on"), hold=300).orderBy("active_since").collect()
    assert [(r.active_since.minute, r.active_until.minute, r.evaluations, r.fired) for r in got] == [
        (1, 6, 6, True), (9, 9, 1, False), (20, 20, 1, False)]


def test_heartbeat_gaps_equal_pairwise(rows):
    rng = np.random.default_rng(4)
    seconds = sorted(set(rng.integers(0, 20_000, 300).tolist()))
    got = alerts.heartbeat_gaps(events(rows, *[(s, 1.0) for s in seconds]), ["service"], limit=60)
    want = {(a, b) for a, b in zip(seconds, seconds[1:]) if b - a > 60}
    assert {((r.gap_start - T0).total_seconds(), (r.gap_end - T0).total_seconds()) for r in got.collect()} == want


def test_hot_right_side_is_cut_along_time(spark):
    """One key and day with most rows of the right side: pieces of about the wanted size, and the same matches."""
    right = spark.range(60_000).selectExpr(
        "if(id < 50000, 'hot', concat('k', id % 50)) AS city", "id AS r",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(if(id < 50000, 0, id % 20), if(id < 45000, 3, 5), 0, id % 50000 / 50.0) AS ts")
    left = spark.range(3_000).selectExpr(
        "if(id % 2 = 0, 'hot', concat('k', id % 50)) AS city", "id AS l",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(if(id % 2 = 0, 0, id % 20), 3, 0, id / 3.0) AS ts")
    by, at = ["city", "__b"], F.unix_micros(F.col("ts").cast("timestamp"))
    bucket = F.lit(0).alias("__b")
    day = [side.filter("ts < timestamp_ntz'2024-01-02 00:00:00'").select("city", "ts", bucket) for side in (left, right)]
    cuts = lookups._cuts(*day, by, at, 2000)
    hot = day[1].join(cuts, by).withColumn("p", F.size(F.filter("__cuts", lambda c: c <= at))).groupBy("p").count().collect()
    assert len(hot) > 20 and max(r["count"] for r in hot) < 3 * 2000
    got = lookups.as_of_join(left, right, ["city"], "ts", ["r"], 24, 2000).toPandas().sort_values("l")
    want = pd.merge_asof(left.toPandas().sort_values("ts"), right.toPandas().sort_values(["ts", "r"]), on="ts", by="city").sort_values("l")
    assert got["r"].tolist() == want["r"].tolist() or got["r"].fillna(-1).tolist() == want["r"].fillna(-1).tolist()


def test_newest_rows_need_no_sort_of_all_rows(rows, spark):
    """Raw rows are hash-aggregated; what is compared as a whole lies above the join that leaves the newest ones."""
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    found = lookups.last_known(events, ["event_type"], "ts", ["value"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortAggregate") < plan.index("Join") < plan.rindex("HashAggregate")
    assert "SortAggregate" not in plan[plan.index("Join"):]
