"""Monitoring rules over request events: rates, ratios, quantiles, holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Upper bounds of the latency histogram unless the caller gives others; values above the last are counted as overflow
LATENCY_BOUNDS = [0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0]
#: Steps of a bucket that is put in order on its own
BUCKET_STEPS = 1440


def _pane(ts: str, step: int) -> Column:
    return (F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / step) * step).cast("bigint")


def _at(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def panes(df: DataFrame, keys: Sequence[str], ts: str, step: int, aggs: Sequence[Column]) -> DataFrame:
    """Partial results per key and step; the only pass over the raw events."""
    return df.groupBy(*keys, _pane(ts, step).alias("__p")).agg(*aggs)


def trailing(pane: DataFrame, keys: Sequence[str], step: int, span: int,
             totals: Sequence[Column]) -> DataFrame:
    """Combine panes into trailing windows that end at every step (``eval_ts``)."""
    ends = F.sequence(F.col("__p") + step, F.col("__p") + span, F.lit(step).cast("bigint"))
    return (pane.withColumn("__end", F.explode(ends)).groupBy(*keys, "__end").agg(*totals)
            .withColumn("eval_ts", _at(F.col("__end"))).drop("__end"))


def request_rate(df: DataFrame, keys: Sequence[str], ts: str = "ts", span: int = 60,
                 step: int = 60) -> DataFrame:
    """Requests per second over the trailing ``span`` seconds."""
    pane = panes(df, keys, ts, step, [F.count(F.lit(1)).alias("__n")])
    return trailing(pane, keys, step, span, [F.sum("__n").alias("requests")]).withColumn(
        "rate", F.col("requests") / float(span))


def error_ratio(df: DataFrame, keys: Sequence[str], failed: Column, ts: str = "ts",
                span: int = 300, step: int = 60) -> DataFrame:
    """Failed requests over all requests in the trailing window."""
    pane = panes(df, keys, ts, step, [F.count(F.lit(1)).alias("__n"), F.count_if(failed).alias("__f")])
    return trailing(pane, keys, step, span, [
        F.sum("__n").alias("requests"), F.sum("__f").alias("failed")]).withColumn(
        "ratio", F.col("failed") / F.col("requests"))


def bucket_counts(value: Column, bounds: Sequence[float]) -> list[Column]:
    """One counter per histogram bucket, the last one for values above every bound."""
    counters = []
    for i in range(len(bounds) + 1):
        above = F.lit(True) if i == 0 else value > bounds[i - 1]
        counters.append(F.count_if(above & (value <= bounds[i]) if i < len(bounds) else above).alias(f"__b{i}"))
    return counters


def with_bucket_quantile(df: DataFrame, q: float, bounds: Sequence[float]) -> DataFrame:
    """Replace the bucket counters by ``requests``, ``overflow`` and the interpolated ``quantile``.

    ``overflow`` counts values above the last bound; a quantile among them is NULL, as
    the histogram does not know it.
    """
    counters = [F.col(f"__b{i}") for i in range(len(bounds) + 1)]
    rank, below, result = F.col("requests") * q, F.lit(0), F.when(F.lit(False), F.lit(0.0))
    for i, upper in enumerate(bounds):
        lower = 0.0 if i == 0 else bounds[i - 1]
        inside = lower + (upper - lower) * (rank - below) / counters[i]
        below = below + counters[i]
        result = result.when((below >= rank) & (counters[i] > 0), inside)
    return (df.withColumn("requests", sum(counters[1:], counters[0]))
            .withColumn("quantile", result).withColumn("overflow", counters[-1])
            .drop(*[f"__b{i}" for i in range(len(counters))]))


def histogram_quantile(df: DataFrame, keys: Sequence[str], value: str, ts: str = "ts",
                       q: float = 0.95, span: int = 300, step: int = 60,
                       bounds: Sequence[float] = tuple(LATENCY_BOUNDS)) -> DataFrame:
    """Quantile of a fixed-bound histogram over the trailing window, interpolated in its bucket.

    A window holds one counter per bucket, however many requests it covers.
    """
    pane = panes(df, keys, ts, step, bucket_counts(F.col(value), bounds))
    totals = [F.sum(f"__b{i}").alias(f"__b{i}") for i in range(len(bounds) + 1)]
    return with_bucket_quantile(trailing(pane, keys, step, span, totals), q, bounds)


def sustained(evaluations: DataFrame, keys: Sequence[str], firing: Column, hold: int,
              step: int = 60, ts: str = "eval_ts") -> DataFrame:
    """Runs of consecutive firing evaluations, and whether they lasted ``hold`` seconds.

    Gaps and islands over one row per evaluation: the step number minus the
    rank is constant within a run. A missing evaluation ends a run. Runs are found
    within buckets of time; only those that touch a bucket's edge, at most two a
    bucket, are put in order over a whole key.
    """
    number = (F.unix_seconds(F.col(ts).cast("timestamp")) / step).cast("bigint")
    numbered = evaluations.filter(firing).withColumn("__no", number).withColumn(
        "__b", F.floor(F.col("__no") / BUCKET_STEPS))
    order = Window.partitionBy(*keys, "__b").orderBy("__no")
    parts = numbered.withColumn("__i", F.col("__no") - F.row_number().over(order)).groupBy(*keys, "__b", "__i").agg(
        F.min("__no").alias("__first"), F.max("__no").alias("__last"), F.min(ts).alias("active_since"),
        F.max(ts).alias("active_until"), F.count(F.lit(1)).alias("evaluations"))
    at_edge = (F.col("__first") % BUCKET_STEPS == 0) | (F.col("__last") % BUCKET_STEPS == BUCKET_STEPS - 1)
    along = Window.partitionBy(*keys).orderBy("__first")
    new = F.coalesce(F.col("__first") != F.lag("__last").over(along) + 1, F.lit(True)).cast("bigint")
    joined = (parts.filter(at_edge).withColumn("__new", new)
              .withColumn("__run", F.sum("__new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*keys, "__run").agg(F.min("active_since").alias("active_since"), F.max("active_until").alias("active_until"),
                                           F.sum("evaluations").alias("evaluations")).drop("__run"))
    runs = parts.filter(~at_edge).select(*keys, "active_since", "active_until", "evaluations").unionByName(joined)
    return runs.withColumn("fired", F.unix_seconds(F.col("active_until").cast("timestamp"))
                           - F.unix_seconds(F.col("active_since").cast("timestamp")) >= hold)


def heartbeat_gaps(df: DataFrame, keys: Sequence[str], ts: str = "ts", limit: int = 60) -> DataFrame:
    """Silences longer than ``limit`` seconds per target.

    Heartbeats are first reduced to the first and last one per slot of ``limit``
    seconds: no silence longer than that fits inside a slot. Slots are put in order
    within buckets of time, and the buckets' first and last beats over a whole key.
    """
    slots = panes(df, keys, ts, limit, [F.min(ts).alias("__first"), F.max(ts).alias("__last")]).withColumn(
        "__b", F.floor(F.col("__p") / (limit * BUCKET_STEPS)))
    gap = (F.unix_micros(F.col("gap_end").cast("timestamp"))
           - F.unix_micros(F.col("gap_start").cast("timestamp"))) / 1e6

    def silences(rows: DataFrame, within: Sequence[str], by: str) -> DataFrame:
        before = F.lag("__last").over(Window.partitionBy(*within).orderBy(by))
        return rows.withColumn("gap_start", before).select(*keys, "gap_start", F.col("__first").alias("gap_end"))

    edges = slots.groupBy(*keys, "__b").agg(F.min("__first").alias("__first"), F.max("__last").alias("__last"))
    found = silences(slots, [*keys, "__b"], "__p").unionByName(silences(edges, keys, "__b"))
    return found.withColumn("gap_seconds", gap).filter(F.col("gap_seconds") > limit)


def requests_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("requests"))
