"""Queries on request rates, error ratios, latency and heartbeats (events as requests)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.operators import alerts
from hourgrid.plans.bindings import table
from hourgrid.plans.catalog import query

SERVICE = ["service"]
RATE_LIMIT, LATENCY_LIMIT = 0.03, 100.0


def _requests(spark, sf):
    """Every event is a request of one service; an error event failed; value is its latency."""
    return table(spark, sf, "events").select(
        F.lit("api").alias("service"), "ts", F.col("event_type").alias("endpoint"),
        (F.col("event_type") == "error").alias("failed"), F.col("value").alias("latency"), "user_id")


PANES = """panes AS (SELECT epoch(date_trunc('minute', ts))::BIGINT AS p, * FROM events),
spread AS (SELECT make_timestamp((p + 60*i) * 1000000) AS eval_ts, e.* FROM panes e, (SELECT unnest(range(1, 6)) AS i))"""


@query("request_rate", """
SELECT 'api' AS service, make_timestamp((epoch(date_trunc('minute', ts))::BIGINT + 60)*1000000) AS eval_ts, count(*)::BIGINT AS requests,
 count(*)/60.0::DOUBLE AS rate FROM events GROUP BY ALL""")
def _(spark, sf):
    return alerts.request_rate(_requests(spark, sf), SERVICE)


@query("error_ratio", "WITH " + PANES + """
SELECT 'api' AS service, eval_ts, count(*)::BIGINT AS requests, count(*) FILTER (WHERE event_type = 'error')::BIGINT AS failed,
 (count(*) FILTER (WHERE event_type = 'error'))::DOUBLE/count(*) AS ratio FROM spread GROUP BY eval_ts""")
def _(spark, sf):
    return alerts.error_ratio(_requests(spark, sf), SERVICE, F.col("failed"))


def _quantile_sql(q: float) -> str:
    bounds = alerts.LATENCY_BOUNDS
    counts = ", ".join(f"count(*) FILTER (WHERE value <= {b}::DOUBLE) AS c{i}" for i, b in enumerate(bounds))
    cases, lower = [], "0::DOUBLE"
    for i, b in enumerate(bounds):
        below = f"c{i-1}" if i else "0"
        cases.append(f"WHEN c{i} >= n*{q}::DOUBLE AND c{i} > {below} THEN {lower} + ({b}::DOUBLE - {lower})*(n*{q}::DOUBLE - {below})/(c{i} - {below})")
        lower = f"{b}::DOUBLE"
    return ("WITH " + PANES + f", h AS (SELECT eval_ts, count(*) AS n, {counts} FROM spread GROUP BY eval_ts) "
            f"SELECT 'api' AS service, eval_ts, n::BIGINT AS requests, round(CASE {' '.join(cases)} END, 9) AS quantile, (n - c{len(bounds) - 1})::BIGINT AS overflow FROM h")


@query("latency_p95", _quantile_sql(0.95))
def _(spark, sf):
    out = alerts.histogram_quantile(_requests(spark, sf), SERVICE, "latency")
    return out.withColumn("quantile", F.round("quantile", 9))


@query("sustained_alerts", "WITH " + PANES + """
, ratio AS (SELECT eval_ts, count(*) FILTER (WHERE event_type = 'error')::DOUBLE/count(*) AS ratio FROM spread GROUP BY eval_ts),
firing AS (SELECT eval_ts, epoch(eval_ts)::BIGINT // 60 - row_number() OVER (ORDER BY eval_ts) AS i FROM ratio WHERE ratio > 0.05)
SELECT 'api' AS service, min(eval_ts) AS active_since, max(eval_ts) AS active_until, count(*)::BIGINT AS evaluations,
 epoch(max(eval_ts)) - epoch(min(eval_ts)) >= 300 AS fired FROM firing GROUP BY i""")
def sustained_alerts(spark, sf):
    ratio = alerts.error_ratio(_requests(spark, sf), SERVICE, F.col("failed"))
    return alerts.sustained(ratio, SERVICE, F.col("ratio") > 0.05, hold=300)


@query("rate_alerts", f"""
WITH rate AS (SELECT make_timestamp((epoch(date_trunc('minute', ts))::BIGINT + 60)*1000000) AS eval_ts, count(*)/60.0::DOUBLE AS rate FROM events GROUP BY 1),
firing AS (SELECT eval_ts, epoch(eval_ts)::BIGINT // 60 - row_number() OVER (ORDER BY eval_ts) AS i FROM rate WHERE rate > {RATE_LIMIT}::DOUBLE)
SELECT 'api' AS service, min(eval_ts) AS active_since, max(eval_ts) AS active_until, count(*)::BIGINT AS evaluations,
 epoch(max(eval_ts)) - epoch(min(eval_ts)) >= 120 AS fired FROM firing GROUP BY i""")
def _(spark, sf):
    rate = alerts.request_rate(_requests(spark, sf), SERVICE)
    return alerts.sustained(rate, SERVICE, F.col("rate") > RATE_LIMIT, hold=120)


@query("latency_alerts", "WITH p95 AS (" + _quantile_sql(0.95) + f"""),
firing AS (SELECT eval_ts, epoch(eval_ts)::BIGINT // 60 - row_number() OVER (ORDER BY eval_ts) AS i FROM p95 WHERE quantile > {LATENCY_LIMIT}::DOUBLE)
SELECT 'api' AS service, min(eval_ts) AS active_since, max(eval_ts) AS active_until, count(*)::BIGINT AS evaluations,
 epoch(max(eval_ts)) - epoch(min(eval_ts)) >= 300 AS fired FROM firing GROUP BY i""")
def _(spark, sf):
    p95 = alerts.histogram_quantile(_requests(spark, sf), SERVICE, "latency")
    p95 = p95.withColumn("quantile", F.round("quantile", 9))
    return alerts.sustained(p95, SERVICE, F.col("quantile") > LATENCY_LIMIT, hold=300)


@query("heartbeat_gaps", """
SELECT endpoint, gap_start, gap_end, (epoch_us(gap_end) - epoch_us(gap_start))/1e6::DOUBLE AS gap_seconds FROM (
 SELECT event_type AS endpoint, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS gap_start, ts AS gap_end FROM events)
WHERE epoch_us(gap_end) - epoch_us(gap_start) > 3600000000""")
def _(spark, sf):
    return alerts.heartbeat_gaps(_requests(spark, sf), ["endpoint"], limit=3600)


@query("requests_by_status", """
SELECT event_type AS endpoint, event_type = 'error' AS failed, count(*)::BIGINT AS requests FROM events GROUP BY ALL""")
def _(spark, sf):
    return alerts.requests_by(_requests(spark, sf), ["endpoint", "failed"])
