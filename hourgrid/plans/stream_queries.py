"""Streaming jobs run to the end of the landed data; results read back from their sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.dimensions import ALERT_RULES
from hourgrid.functions.index import pm25_to_aqi
from hourgrid.operators.alerts import LATENCY_BOUNDS
from hourgrid.operators.baseline import baseline_for
from hourgrid.plans.bindings import HOURLY_CTE, KEYS, index_sql, table, with_ctes
from hourgrid.plans.catalog import query
from hourgrid.plans.drift_queries import ANNUAL, AS_OF, DRIFT_NUMBERS, _drift_sql, _inputs
from hourgrid.plans.monitoring_queries import LATENCY_LIMIT, PANES, RATE_LIMIT, _quantile_sql
from hourgrid.session import fresh_path
from hourgrid.sources import baselines
from hourgrid.sources.stores import read_store
from hourgrid.streaming import jobs, rules


def _stream(spark, sf):
    schema = table(spark, sf, "events").schema
    # a pattern rather than a plain name: the table may be one file or a folder of files
    rows = jobs.read_landed(spark, f"{sf}/events.parque[t]", schema).select(
        F.col("event_type").alias("city"), F.col("user_id").alias("station"), "ts",
        F.col("value").alias("pm25"), "event_id")
    return jobs.event_time(rows, "ts")


def _finish(started):
    started.awaitTermination()
    if started.exception() is not None:
        raise started.exception()


CLOSED = "(SELECT max(ts) - INTERVAL 2 HOUR FROM events)"


@query("stream_hourly_mean", with_ctes(HOURLY_CTE) + f"""
SELECT city, ts, round(pm25, 9) AS pm25, n::BIGINT AS n FROM hourly0 WHERE ts + INTERVAL 1 HOUR <= {CLOSED}""")
def stream_hourly_mean(spark, sf):
    out, checkpoint = fresh_path(spark, "stream-hourly"), fresh_path(spark, "checkpoint")
    _finish(jobs.append_to(jobs.hourly_mean(_stream(spark, sf), KEYS, "ts", "pm25", decimals=2), out, checkpoint))
    return spark.read.parquet(out).select("city", F.col("ts").cast("timestamp_ntz").alias("ts"),
                                          F.round("pm25", 9).alias("pm25"), "n")


@query("stream_dedupe", """
SELECT event_type AS city, user_id AS station, ts, count(*)::BIGINT AS copies FROM (SELECT DISTINCT event_type, user_id, ts FROM events) GROUP BY ALL""")
def stream_dedupe(spark, sf):
    """The landed rows arrive twice (overlapping polls); each (city, station, time) is kept once."""
    out, checkpoint = fresh_path(spark, "stream-dedupe"), fresh_path(spark, "checkpoint")
    twice = _stream(spark, sf).union(_stream(spark, sf)).select("city", "station", "ts")
    _finish(jobs.append_to(jobs.dedupe(twice, ["city", "station"], "ts"), out, checkpoint))
    rows = spark.read.parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return rows.groupBy("city", "station", "ts").agg(F.count(F.lit(1)).alias("copies"))


@query("stream_last_known", """
SELECT event_type AS city, max(ts) AS ts, arg_max(value, (ts, event_id)) AS pm25, max(ts) = max(ts) AS known FROM events GROUP BY 1""")
def stream_last_known(spark, sf):
    out, checkpoint = fresh_path(spark, "stream-last"), fresh_path(spark, "checkpoint")
    _finish(jobs.replace_in(jobs.last_known(_stream(spark, sf), KEYS, "ts", ["event_id", "pm25"]), out, checkpoint))
    return spark.read.parquet(out).select("city", F.col("ts").cast("timestamp_ntz").alias("ts"), "pm25",
                                          F.lit(True).alias("known"))


@query("stream_request_windows", f"""
WITH p AS (SELECT epoch(date_trunc('hour', ts))::BIGINT AS h, * FROM events),
s AS (SELECT make_timestamp((h + 3600*i)*1000000) AS eval_ts, event_type FROM p, (SELECT unnest(range(1, 5)) AS i))
SELECT eval_ts, count(*)::BIGINT AS requests, count(*) FILTER (WHERE event_type = 'error')::BIGINT AS failed FROM s
WHERE eval_ts <= {CLOSED} GROUP BY eval_ts""")
def _(spark, sf):
    out, checkpoint = fresh_path(spark, "stream-windows"), fresh_path(spark, "checkpoint")
    counts = jobs.sliding_counts(_stream(spark, sf), [], "ts", F.col("city") == "error", "4 hours", "1 hour")
    _finish(jobs.append_to(counts, out, checkpoint))
    return spark.read.parquet(out).withColumn("eval_ts", F.col("eval_ts").cast("timestamp_ntz"))


def _latency_sql() -> str:
    """The hourly panes of four-hour windows, ranked inside their histogram bucket."""
    bounds = LATENCY_BOUNDS
    counts = ", ".join(f"count(*) FILTER (WHERE value <= {b}::DOUBLE) AS c{i}" for i, b in enumerate(bounds))
    cases, lower = [], "0::DOUBLE"
    for i, b in enumerate(bounds):
        below = f"c{i - 1}" if i else "0"
        cases.append(f"WHEN c{i} >= n*0.95::DOUBLE AND c{i} > {below} THEN {lower} + ({b}::DOUBLE - {lower})*(n*0.95::DOUBLE - {below})/(c{i} - {below})")
        lower = f"{b}::DOUBLE"
    return f"""WITH p AS (SELECT epoch(date_trunc('hour', ts))::BIGINT AS h, * FROM events),
s AS (SELECT make_timestamp((h + 3600*i)*1000000) AS eval_ts, event_type AS city, value FROM p, (SELECT unnest(range(1, 5)) AS i)),
c AS (SELECT city, eval_ts, count(*) AS n, {counts} FROM s GROUP BY ALL)
SELECT city, eval_ts, n::BIGINT AS requests, round(CASE {' '.join(cases)} END, 9) AS quantile, (n - c{len(bounds) - 1})::BIGINT AS overflow FROM c WHERE eval_ts <= {CLOSED}"""


@query("stream_latency_p95", _latency_sql())
def _(spark, sf):
    out, checkpoint = fresh_path(spark, "stream-latency"), fresh_path(spark, "checkpoint")
    p95 = jobs.sliding_quantile(_stream(spark, sf), KEYS, "ts", "pm25", "4 hours", "1 hour")
    _finish(jobs.append_to(p95, out, checkpoint))
    return spark.read.parquet(out).select("city", F.col("eval_ts").cast("timestamp_ntz").alias("eval_ts"),
                                          "requests", F.round("quantile", 9).alias("quantile"), "overflow")


@query("stream_sessions", """
WITH marks AS (SELECT event_type AS city, user_id AS station, ts,
 coalesce(ts - lag(ts) OVER (PARTITION BY event_type, user_id ORDER BY ts) > INTERVAL 3 HOUR, true) AS fresh FROM events),
runs AS (SELECT *, sum(fresh::INTEGER) OVER (PARTITION BY city, station ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM marks)
SELECT city, station, min(ts) AS up_since, max(ts) AS last_seen, count(*)::BIGINT AS beats FROM runs GROUP BY city, station, run
HAVING max(ts) + INTERVAL 3 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)""")
def _(spark, sf):
    out, checkpoint = fresh_path(spark, "stream-sessions"), fresh_path(spark, "checkpoint")
    _finish(jobs.append_to(jobs.heartbeat_sessions(_stream(spark, sf), ["city", "station"], "ts", "3 hours"), out, checkpoint))
    return spark.read.parquet(out).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("up_since", "last_seen")})


LATE = "2024-01-10 00:00:00"


@query("stream_late_rows", f"""
SELECT event_type AS city, date_trunc('hour', ts)::TIMESTAMP AS ts, count(*)::BIGINT AS n FROM events
WHERE ts >= TIMESTAMP '{LATE}' AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= {CLOSED} GROUP BY ALL""")
def stream_late_rows(spark, sf):
    """The rows before a day arrive after all others, behind the watermark: they change nothing."""
    out, checkpoint, landed = (fresh_path(spark, n) for n in ("stream-late", "checkpoint", "landed"))
    events = table(spark, sf, "events").select(F.col("event_type").alias("city"), "ts", F.col("value").alias("pm25"))
    late = F.col("ts") < F.lit(LATE).cast("timestamp_ntz")
    for part in (events.filter(~late), events.filter(late)):
        part.write.mode("append").parquet(landed)
        rows = jobs.event_time(jobs.read_landed(spark, landed, events.schema), "ts")
        _finish(jobs.append_to(jobs.hourly_mean(rows, KEYS, "ts", "pm25", decimals=2), out, checkpoint))
    return spark.read.parquet(out).select("city", F.col("ts").cast("timestamp_ntz").alias("ts"), "n")


@query("stream_late_accounted", f"""
SELECT event_type AS city, ts >= TIMESTAMP '{LATE}' OR date_trunc('hour', ts) + INTERVAL 1 HOUR > {CLOSED} AS kept, count(*)::BIGINT AS n FROM events GROUP BY ALL
UNION ALL SELECT 'landed', true, count(*)::BIGINT FROM events""")
def stream_late_accounted(spark, sf):
    """The rows before a day arrive after all others: they lie apart, and kept and late ones add up to all."""
    paths = {n: fresh_path(spark, f"accounted-{n}") for n in ("landed", "kept", "late", "marks", "checkpoint")}
    events = table(spark, sf, "events").select(F.col("event_type").alias("city"), "ts", F.col("value").alias("pm25"))
    early = F.col("ts") < F.lit(LATE).cast("timestamp_ntz")
    for part in (events.filter(~early), events.filter(early)):
        part.write.mode("append").parquet(paths["landed"])
        rows = jobs.event_time(jobs.read_landed(spark, paths["landed"], events.schema), "ts")
        _finish(jobs.late_apart(rows, "ts", paths["kept"], paths["late"], paths["marks"], paths["checkpoint"]))
    counts = [spark.read.parquet(paths[n]).groupBy("city").agg(F.count(F.lit(1)).alias("n")).select(
        "city", F.lit(n == "kept").alias("kept"), "n") for n in ("kept", "late")]
    both = counts[0].unionByName(counts[1])
    return both.unionByName(both.agg(F.sum("n").alias("n")).select(F.lit("landed").alias("city"), F.lit(True).alias("kept"), "n"))


def _run_changes(name: str, evaluations: str, hold: int) -> str:
    """The changes of one rule, from the minutes in which it holds: gaps and islands."""
    return f"""{name} AS (SELECT '{name}' AS rule, min(eval_ts) AS since, max(eval_ts) AS last, {hold} AS hold FROM (
 SELECT eval_ts, epoch(eval_ts)::BIGINT // 60 - row_number() OVER (ORDER BY eval_ts) AS i FROM ({evaluations}) WHERE eval_ts <= {CLOSED}) GROUP BY i)"""


RULES = [rules.Rule("rate", "rate", RATE_LIMIT, *ALERT_RULES["HighRequestRate"][1:]),
         rules.Rule("ratio", "ratio", *ALERT_RULES["HighErrorRate"]),
         rules.Rule("latency", "quantile", LATENCY_LIMIT, *ALERT_RULES["SlowResponseTime"][1:])]
CHANGES_SQL = "WITH " + PANES + ", p95 AS (" + _quantile_sql(0.95).replace("round(CASE", "(CASE").replace("END, 9)", "END)") + "),\n" + ",\n".join([
    _run_changes("rate", f"SELECT make_timestamp((p + 60)*1000000) AS eval_ts FROM panes GROUP BY p HAVING count(*)/60.0::DOUBLE > {RATE_LIMIT}::DOUBLE", RULES[0].hold),
    _run_changes("ratio", f"SELECT eval_ts FROM spread GROUP BY eval_ts HAVING count(*) FILTER (WHERE event_type = 'error')::DOUBLE/count(*) > {RULES[1].limit}::DOUBLE", RULES[1].hold),
    _run_changes("latency", f"SELECT eval_ts FROM p95 WHERE quantile > {LATENCY_LIMIT}::DOUBLE", RULES[2].hold),
    "runs AS (SELECT *, epoch(last) - epoch(since) >= hold AS fired FROM (FROM rate UNION ALL FROM ratio UNION ALL FROM latency))"]) + f"""
SELECT 'api' AS service, rule, 'pending' AS state, since AS at, since FROM runs
UNION ALL SELECT 'api', rule, 'firing', since + to_seconds(hold), since FROM runs WHERE fired
UNION ALL SELECT 'api', rule, CASE WHEN fired THEN 'resolved' ELSE 'lapsed' END, last + INTERVAL 1 MINUTE, since FROM runs WHERE last + INTERVAL 1 MINUTE <= {CLOSED}"""


@query("stream_alert_rules", CHANGES_SQL)
def stream_alert_rules(spark, sf):
    """Rate, error-ratio and latency rules, each at its own window and hold: every change of state."""
    out, checkpoint = fresh_path(spark, "stream-rules"), fresh_path(spark, "checkpoint")
    requests = _stream(spark, sf).withColumn("service", F.lit("api"))
    changes = rules.alert_changes(requests, ["service"], "ts", RULES, F.col("city") == "error", F.col("pm25"))
    _finish(rules.append_changes(changes, out, checkpoint))
    return spark.read.parquet(out).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("at", "since")})


DAY = 86400


@query("stream_target_down", f"""
WITH beats AS (SELECT event_type AS city, user_id AS station, ts FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= {CLOSED}),
pairs AS (SELECT city, station, ts AS last_seen, lead(ts) OVER (PARTITION BY city, station ORDER BY ts) AS next FROM beats),
silent AS (SELECT * FROM pairs WHERE next - last_seen > INTERVAL 1 DAY OR (next IS NULL AND date_trunc('day', last_seen) + INTERVAL 2 DAY <= {CLOSED}))
SELECT city, station, 'down' AS state, last_seen + INTERVAL 1 DAY AS at, last_seen FROM silent
UNION ALL SELECT city, station, 'up', next, last_seen FROM silent WHERE next IS NOT NULL""")
def stream_target_down(spark, sf):
    """Stations that send nothing for a day: down while they are silent, up with the next reading."""
    out, checkpoint = fresh_path(spark, "stream-down"), fresh_path(spark, "checkpoint")
    _finish(rules.append_changes(rules.silences(_stream(spark, sf), ["city", "station"], "ts", DAY), out, checkpoint))
    return spark.read.parquet(out).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("at", "last_seen")})


THRESHOLD, SPAN, HOLD = ALERT_RULES["HighErrorRate"]


@query("stream_alerts", "WITH " + PANES + f""",
ratio AS (SELECT eval_ts, count(*) FILTER (WHERE event_type = 'error')::DOUBLE/count(*) AS ratio FROM spread GROUP BY eval_ts),
firing AS (SELECT eval_ts, epoch(eval_ts)::BIGINT // 60 - row_number() OVER (ORDER BY eval_ts) AS i FROM ratio
 WHERE ratio > {THRESHOLD} AND eval_ts <= {CLOSED})
SELECT min(eval_ts) AS active_since, max(eval_ts) AS active_until, count(*)::BIGINT AS evaluations,
 epoch(max(eval_ts)) - epoch(min(eval_ts)) >= {HOLD} AS fired FROM firing GROUP BY i""")
def stream_alerts(spark, sf):
    """The error-ratio rule at its own window and hold, over the closed minutes."""
    log, out, checkpoint = (fresh_path(spark, n) for n in ("evaluations", "alerts", "checkpoint"))
    counts = jobs.sliding_counts(_stream(spark, sf).withColumn("service", F.lit("api")), ["service"], "ts",
                                 F.col("city") == "error", f"{SPAN} seconds", "1 minute")
    firing = F.col("failed") / F.col("requests") > THRESHOLD
    _finish(jobs.alerts_after_batch(counts, log, out, checkpoint, ["service"], firing, HOLD))
    found = spark.read.parquet(out)
    last = found.agg(F.max("batch")).first()[0]
    return found.filter(F.col("batch") == last).drop("batch", "service")


MEANS_CTE = f"""sh AS (SELECT event_type AS city, user_id AS station, date_trunc('hour', ts)::TIMESTAMP AS ts,
  sum(round(value*100)::BIGINT)::DOUBLE/(count(value)*100)::DOUBLE AS pm25 FROM events GROUP BY ALL),
means AS (SELECT city, ts, round(avg(pm25), 6) AS pm25, count(*)::BIGINT AS stations FROM sh WHERE ts + INTERVAL 1 HOUR <= {CLOSED} GROUP BY ALL)"""


def _city_hours(spark, sf):
    means = jobs.city_hour_mean(_stream(spark, sf), KEYS, "station", "ts", "pm25", decimals=2)
    return means.withColumn("pm25", F.round("pm25", 6))


@query("stream_upsert", "WITH " + MEANS_CTE + " SELECT city, ts, pm25, stations FROM means")
def stream_upsert(spark, sf):
    """The means of every closed hour's station means, merged into a day-partitioned store."""
    out, checkpoint = fresh_path(spark, "stream-store"), fresh_path(spark, "checkpoint")
    _finish(jobs.upsert_to_days(_city_hours(spark, sf), out, checkpoint, KEYS, "ts", ["pm25"]))
    return read_store(spark, out).select("city", F.col("ts").cast("timestamp_ntz").alias("ts"), "pm25", "stations")


NEWEST = "(SELECT max(ts) FROM means)"
STREAM_RECENT_CTE = MEANS_CTE + f""",
recent AS (SELECT city, ts, {index_sql('pm25')}::DOUBLE AS aqi FROM means WHERE ts >= {NEWEST} - INTERVAL 7 DAY)"""


@query("stream_drift", with_ctes(HOURLY_CTE, STREAM_RECENT_CTE) + "," + _drift_sql(ANNUAL, "annual").replace(
    f"TIMESTAMP '{AS_OF}'", NEWEST))
def stream_drift(spark, sf):
    """Upsert every closed hour's mean, then check drift on the store's seven days up to the newest of them."""
    features, series = _inputs(spark, sf)
    paths = {n: fresh_path(spark, n) for n in ("drift-store", "drift-results", "retrain", "checkpoint", "drift-samples")}
    baselines.write_samples(baseline_for(features, KEYS, None), paths["drift-samples"], KEYS)
    rows = _city_hours(spark, sf).select("city", "ts", pm25_to_aqi(F.col("pm25")).alias("aqi"))
    _finish(jobs.drift_after_batch(
        rows, paths["drift-store"], paths["drift-results"], paths["retrain"], paths["checkpoint"], KEYS,
        "ts", "aqi", paths["drift-samples"], series, ["aqi"]))
    out = spark.read.parquet(paths["drift-results"]).drop("batch")
    return out.withColumns({n: F.round(n, 9) for n in DRIFT_NUMBERS})
