"""Streaming ingest: hourly means, de-duplication, last-known values, upsert, drift.

Event time columns must be ``timestamp``; watermarks reject zone-less columns.
Every job takes its folders as arguments; checkpoints and sinks belong on
storage that all executors reach.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hourgrid.operators.alerts import LATENCY_BOUNDS, bucket_counts, sustained, with_bucket_quantile
from hourgrid.operators.drift import check_drift, recent_hourly, retrain_list
from hourgrid.operators.rollup import mean_of
from hourgrid.sources.baselines import read_samples
from hourgrid.sources.stores import read_store, upsert_days, within

LATENESS = "2 hours"


def read_landed(spark: SparkSession, path: str, schema: T.StructType,
                files_per_trigger: int | None = None) -> DataFrame:
    """Landed Parquet files as a stream; the schema is given, never inferred."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(path)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def dedupe(df: DataFrame, keys: Sequence[str], ts: str, lateness: str = LATENESS) -> DataFrame:
    """Drop repeats of (keys, ts); state is kept only as long as late rows may come."""
    return df.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([*keys, ts])


def hourly_mean(df: DataFrame, keys: Sequence[str], ts: str, value: str, lateness: str = LATENESS,
                decimals: int | None = None) -> DataFrame:
    """Tumbling hourly mean per key; an hour is emitted once the watermark has passed it."""
    windowed = df.withWatermark(ts, lateness).groupBy(*keys, F.window(ts, "1 hour").alias("__w"))
    return windowed.agg(mean_of(value, decimals).alias(value), F.count(value).alias("n")).select(
        *keys, F.col("__w.start").alias(ts), value, "n")


def city_hour_mean(df: DataFrame, keys: Sequence[str], station: str, ts: str, value: str,
                   lateness: str = LATENESS, decimals: int | None = None) -> DataFrame:
    """Mean of the station means per key and hour; an hour is emitted once the watermark has passed it."""
    stations = df.withWatermark(ts, lateness).groupBy(*keys, station, F.window(ts, "1 hour").alias("__w")).agg(
        mean_of(value, decimals).alias(value)).select(*keys, value, F.window_time("__w").alias("__t"))
    return stations.groupBy(*keys, F.window("__t", "1 hour").alias("__h")).agg(
        F.avg(value).alias(value), F.count(value).alias("stations")).select(
        *keys, F.col("__h.start").alias(ts), value, "stations")


def sliding_counts(df: DataFrame, keys: Sequence[str], ts: str, failed: Column, span: str,
                   slide: str, lateness: str = LATENESS) -> DataFrame:
    """Requests and failures per sliding window, for rate and error-ratio rules."""
    windowed = df.withWatermark(ts, lateness).groupBy(*keys, F.window(ts, span, slide).alias("__w"))
    return windowed.agg(F.count(F.lit(1)).alias("requests"), F.count_if(failed).alias("failed")).select(
        *keys, F.col("__w.end").alias("eval_ts"), "requests", "failed")


def sliding_quantile(df: DataFrame, keys: Sequence[str], ts: str, value: str, span: str, slide: str,
                     q: float = 0.95, bounds: Sequence[float] = tuple(LATENCY_BOUNDS),
                     lateness: str = LATENESS) -> DataFrame:
    """Histogram quantile per sliding window; state is one counter per bucket."""
    windowed = df.withWatermark(ts, lateness).groupBy(*keys, F.window(ts, span, slide).alias("__w"))
    counted = windowed.agg(*bucket_counts(F.col(value), bounds)).withColumn("eval_ts", F.col("__w.end"))
    return with_bucket_quantile(counted.drop("__w"), q, bounds)


def heartbeat_sessions(df: DataFrame, keys: Sequence[str], ts: str, gap: str,
                       lateness: str = LATENESS) -> DataFrame:
    """Up-time sessions: a new one starts after a silence longer than ``gap``."""
    sessions = df.withWatermark(ts, lateness).groupBy(*keys, F.session_window(ts, gap).alias("__w"))
    return sessions.agg(F.min(ts).alias("up_since"), F.max(ts).alias("last_seen"),
                        F.count(F.lit(1)).alias("beats")).drop("__w")


def last_known(df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str]) -> DataFrame:
    """Newest row per key so far; state is one row per key."""
    newest = df.groupBy(*keys).agg(F.max(F.struct(ts, *columns)).alias("__last"))
    return newest.select(*keys, F.col(f"__last.{ts}").alias(ts),
                         *[F.col(f"__last.{c}").alias(c) for c in columns])


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows to a Parquet folder; the file sink writes each batch once."""
    return (df.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def replace_in(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep a small result table (one row per key) up to date in complete mode."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return for_each(df, write, checkpoint, "complete")


def for_each(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
             mode: str = "append") -> StreamingQuery:
    return (df.writeStream.foreachBatch(handle).outputMode(mode)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def upsert_to_days(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], ts: str,
                   order: Sequence[str], partition: Sequence[str] = ("city", "date")) -> StreamingQuery:
    """First-wins upsert of every micro-batch into a day-partitioned store.

    A repeated batch only brings rows the store already has, and those lose, so
    a restart cannot change the store.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_days(batch.sparkSession, path, batch, keys, ts, [F.col(c) for c in order], partition)

    return for_each(df, merge, checkpoint)


def drift_after_batch(df: DataFrame, store: str, drift: str, retrain: str, checkpoint: str,
                      keys: Sequence[str], ts: str, value: str, samples: str,
                      series: DataFrame, order: Sequence[str], as_of: str | None = None,
                      days: int = 7) -> StreamingQuery:
    """Upsert a micro-batch of hourly rows, then check drift on the trailing days of the store.

    The check looks back from the newest row of its batch, so it moves with the
    stream, or from a fixed ``as_of``. A batch reads the store's folders of these days and
    the stored samples of the baselines (``write_samples``), never the baselines themselves.
    Batches without rows leave nothing. Results and retrain requests land under their batch
    number, so a repeated batch replaces its own output.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = batch.agg(F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss")).first()[0]
        if newest is None:
            return
        upsert_days(spark, store, batch, keys, ts, [F.col(c) for c in order])
        moment = F.lit(as_of or newest).cast("timestamp_ntz")
        stored = within(read_store(spark, store), moment - F.expr(f"INTERVAL {days} DAYS"), moment)
        sample, sizes = read_samples(spark, samples)
        checked = check_drift(sample, recent_hourly(stored, keys, ts, value, moment, days), series, keys, "annual", moment,
                              days=days, base_sizes=sizes)
        target = f"{drift}/batch={batch_id}"
        checked.write.mode("overwrite").parquet(target)
        retrain_list(spark.read.parquet(target)).select(*keys).write.mode("overwrite").parquet(
            f"{retrain}/batch={batch_id}")

    return for_each(df, handle, checkpoint)


def late_apart(df: DataFrame, ts: str, kept: str, late: str, marks: str, checkpoint: str, span: str = "1 hour",
               lateness: str = LATENESS) -> StreamingQuery:
    """Every landed row into one of two tables: in time, or ``late``.

    A row is late when its window of length ``span`` had ended before the watermark: the
    newest time of all batches before, less ``lateness``. That is the watermark under which
    a windowed aggregation would have left the row out, so what it lacks can be seen, counted
    and taken in later. ``marks`` keeps the newest time of each batch. All three lie under
    their batch number, so a repeated batch replaces its own output.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = None
        if batch_id:
            known = spark.read.schema("newest timestamp, batch long").parquet(marks).filter(F.col("batch") < batch_id)
            newest = known.agg(F.max("newest")).first()[0]
        behind = F.lit(False)
        if newest is not None:
            watermark = F.lit(newest) - F.expr(f"INTERVAL {lateness}")
            behind = F.coalesce(F.window(ts, span)["end"] <= watermark, F.lit(False))
        for path, rows in ((kept, batch.filter(~behind)), (late, batch.filter(behind))):
            rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        batch.agg(F.max(ts).alias("newest")).write.mode("overwrite").parquet(f"{marks}/batch={batch_id}")

    return for_each(df, handle, checkpoint)


def alerts_after_batch(evaluations: DataFrame, log: str, alerts: str, checkpoint: str, keys: Sequence[str],
                       firing: Column, hold: int, step: int = 60) -> StreamingQuery:
    """Keep closed evaluations of a rule, and after each batch the runs in which it fires.

    A run holds over batches, as it is found in the log of all evaluations (a row per
    key and step). Both tables lie under their batch number, so a repeated batch replaces
    its own output.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.withColumn("eval_ts", F.col("eval_ts").cast("timestamp_ntz")).write.mode("overwrite").parquet(
            f"{log}/batch={batch_id}")
        known = spark.read.parquet(log).filter(F.col("batch") <= batch_id).drop("batch")
        sustained(known, keys, firing, hold, step).write.mode("overwrite").parquet(f"{alerts}/batch={batch_id}")

    return for_each(evaluations, handle, checkpoint)
