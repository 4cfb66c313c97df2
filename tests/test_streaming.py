"""Streaming jobs: late rows, duplicates, restarts, equality with batch."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourgrid.streaming import jobs, rules

SCHEMA = "city string, ts timestamp, v double"


def land(spark, folder, name, data):
    df = spark.createDataFrame([(c, datetime.fromisoformat(t), v) for c, t, v in data], SCHEMA)
    df.coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return jobs.read_landed(spark, f"{folder}/*", schema, files_per_trigger=1)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


@pytest.fixture
def folders(tmp_path):
    return {n: str(tmp_path / n) for n in ("in", "out", "ck")}


def test_hourly_mean_drops_too_late_rows(spark, folders):
    land(spark, folders["in"], "b1", [("c", "2024-01-01 00:10:00", 1.0), ("c", "2024-01-01 00:50:00", 3.0)])
    finish(jobs.append_to(jobs.hourly_mean(stream(spark, folders["in"]), ["city"], "ts", "v"), folders["out"], folders["ck"]))
    land(spark, folders["in"], "b2", [("c", "2024-01-01 01:30:00", 5.0), ("c", "2024-01-01 00:20:00", 5.0)])  # late, in time
    finish(jobs.append_to(jobs.hourly_mean(stream(spark, folders["in"]), ["city"], "ts", "v"), folders["out"], folders["ck"]))
    land(spark, folders["in"], "b3", [("c", "2024-01-01 09:00:00", 7.0)])
    finish(jobs.append_to(jobs.hourly_mean(stream(spark, folders["in"]), ["city"], "ts", "v"), folders["out"], folders["ck"]))
    land(spark, folders["in"], "b4", [("c", "2024-01-01 00:30:00", 99.0)])  # too late
    finish(jobs.append_to(jobs.hourly_mean(stream(spark, folders["in"]), ["city"], "ts", "v"), folders["out"], folders["ck"]))
    got = spark.read.parquet(folders["out"]).orderBy("ts").collect()
    assert [(r.ts.hour, r.v, r.n) for r in got] == [(0, 3.0, 3), (1, 5.0, 1)]


def test_dedupe_across_batches(spark, folders):
    rows = [("c", "2024-01-01 00:00:00", 1.0), ("c", "2024-01-01 01:00:00", 2.0)]
    for i, extra in enumerate([[], [("c", "2024-01-01 02:00:00", 3.0)]]):
        land(spark, folders["in"], f"b{i}", rows + extra)
        finish(jobs.append_to(jobs.dedupe(stream(spark, folders["in"]), ["city"], "ts"), folders["out"], folders["ck"]))
    assert sorted(r.v for r in spark.read.parquet(folders["out"]).collect()) == [1.0, 2.0, 3.0]


def test_upsert_survives_a_restart_from_scratch(spark, folders, tmp_path):
    land(spark, folders["in"], "b1", [("c", "2024-01-01 00:00:00", 1.0)])
    finish(jobs.upsert_to_days(stream(spark, folders["in"]), folders["out"], folders["ck"], ["city"], "ts", ["v"]))
    land(spark, folders["in"], "b2", [("c", "2024-01-01 00:00:00", 9.0), ("c", "2024-01-01 01:00:00", 2.0)])
    for checkpoint in (folders["ck"], str(tmp_path / "lost-checkpoint")):  # the second one replays everything
        finish(jobs.upsert_to_days(stream(spark, folders["in"]), folders["out"], checkpoint, ["city"], "ts", ["v"]))
        got = spark.read.parquet(folders["out"]).orderBy("ts").collect()
        assert [(r.ts.hour, r.v) for r in got] == [(0, 1.0), (1, 2.0)]


def test_last_known(spark, folders):
    for i, data in enumerate([[("c", "2024-01-01 05:00:00", 1.0), ("d", "2024-01-01 01:00:00", 4.0)], [("c", "2024-01-01 03:00:00", 2.0), ("d", "2024-01-01 02:00:00", 5.0)]]):
        land(spark, folders["in"], f"b{i}", data)
        finish(jobs.replace_in(jobs.last_known(stream(spark, folders["in"]), ["city"], "ts", ["v"]), folders["out"], folders["ck"]))
    assert {r.city: r.v for r in spark.read.parquet(folders["out"]).collect()} == {"c": 1.0, "d": 5.0}


def test_sliding_counts_and_sessions(spark, folders, tmp_path):
    land(spark, folders["in"], "b1", [("c", f"2024-01-01 00:{m:02d}:00", float(m)) for m in (0, 1, 2, 30, 31)])
    land(spark, folders["in"], "b2", [("c", "2024-01-02 00:00:00", 0.0)])
    rows = stream(spark, folders["in"])
    counts = jobs.sliding_counts(rows, ["city"], "ts", F.col("v") > 30, "5 minutes", "1 minute")
    finish(jobs.append_to(counts, folders["out"], folders["ck"]))
    got = {r.eval_ts.strftime("%H:%M"): (r.requests, r.failed) for r in spark.read.parquet(folders["out"]).collect()}
    assert got["00:03"] == (3, 0) and got["00:32"] == (2, 1) and got["00:36"] == (1, 1)
    sessions = jobs.heartbeat_sessions(rows, ["city"], "ts", "5 minutes")
    finish(jobs.append_to(sessions, str(tmp_path / "s"), str(tmp_path / "sck")))
    runs = spark.read.parquet(str(tmp_path / "s")).orderBy("up_since").collect()
    assert [(r.up_since.minute, r.last_seen.minute, r.beats) for r in runs] == [(0, 2, 3), (30, 31, 2)]


def step(spark, folders, name, data, changes):
    """Land a file and run the stream to the end of what has landed; it goes on from its state."""
    land(spark, folders["in"], name, data)
    finish(rules.append_changes(changes(stream(spark, folders["in"])), folders["out"], folders["ck"]))


def changes_in(spark, folder):
    return {(*r[:-2], *(t.strftime("%d %H:%M:%S") for t in r[-2:])) for r in spark.read.parquet(folder).collect()}


def test_rule_holds_fires_and_resolves_over_restarts(spark, folders):
    """More than 0.03 requests a second for two minutes; nothing arrives when it ends."""
    rule = [rules.Rule("rate", "rate", 0.03, 60, 120), rules.Rule("slow", "quantile", 10.0, 300, 300)]

    def changes(rows):
        return rules.alert_changes(rows, ["city"], "ts", rule, F.col("v") < 0, F.col("v"), lateness="1 minute")

    def minute(m, n, v=0.2):
        return [("c", f"2024-01-01 00:{m:02d}:{10 + s:02d}", v) for s in range(n)]

    step(spark, folders, "b1", minute(0, 2) + minute(1, 1) + minute(2, 2) + minute(3, 3), changes)
    assert changes_in(spark, folders["out"]) == {("c", "rate", "pending", "01 00:01:00", "01 00:01:00"), ("c", "rate", "lapsed", "01 00:02:00", "01 00:01:00")}
    step(spark, folders, "b2", minute(4, 2) + minute(5, 2), changes)
    step(spark, folders, "b3", [("other", "2024-01-01 00:30:00", 20.0)], changes)  # only time goes on for c
    got = changes_in(spark, folders["out"])
    assert {g[2:] for g in got if g[0] == "c"} == {
        ("pending", "01 00:01:00", "01 00:01:00"), ("lapsed", "01 00:02:00", "01 00:01:00"),
        ("pending", "01 00:03:00", "01 00:03:00"), ("firing", "01 00:05:00", "01 00:03:00"), ("resolved", "01 00:07:00", "01 00:03:00")}
    step(spark, folders, "b4", [("third", "2024-01-01 01:30:00", 0.1)], changes)
    assert {g[1:] for g in changes_in(spark, folders["out"]) if g[0] == "other"} == {
        ("slow", "pending", "01 00:31:00", "01 00:31:00"), ("slow", "lapsed", "01 00:36:00", "01 00:31:00")}


def test_target_is_down_while_it_is_silent(spark, folders):
    def changes(rows):
        return rules.silences(rows, ["city"], "ts", 60, lateness="1 minute")

    step(spark, folders, "b1", [("c", "2024-01-01 00:00:10", 1.0), ("c", "2024-01-01 00:00:50", 1.0), ("d", "2024-01-01 00:00:30", 1.0)], changes)
    step(spark, folders, "b2", [("d", "2024-01-01 00:01:20", 1.0), ("d", "2024-01-01 00:02:10", 1.0), ("d", "2024-01-01 00:09:00", 1.0)], changes)
    assert ("c", "down", "01 00:01:50", "01 00:00:50") in changes_in(spark, folders["out"])  # nothing came from c since
    step(spark, folders, "b3", [("c", "2024-01-01 00:12:00", 1.0), ("d", "2024-01-01 00:20:00", 1.0)], changes)
    got = changes_in(spark, folders["out"])
    assert {g[1:] for g in got if g[0] == "c"} == {("down", "01 00:01:50", "01 00:00:50"), ("up", "01 00:12:00", "01 00:00:50"), ("down", "01 00:13:00", "01 00:12:00")}
    assert {g[1:] for g in got if g[0] == "d"} == {("down", "01 00:03:10", "01 00:02:10"), ("up", "01 00:09:00", "01 00:02:10"), ("down", "01 00:10:00", "01 00:09:00")}


def test_histogram_quantile():
    assert rules.histogram_quantile([0, 10, 0], [1.0, 2.0], 0.5) == 1.5
    assert rules.histogram_quantile([0, 0, 3], [1.0, 2.0], 0.5) is None
