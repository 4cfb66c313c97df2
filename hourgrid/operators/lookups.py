"""Last-known values, recent means, fallback chains and set lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.dimensions import DEFAULT_INDEX
from hourgrid.functions.timefns import floor_day, hour_number
from hourgrid.session import saved


def last_known(df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str],
               as_of: Column | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """Newest row per series at or before ``as_of``; of rows of one time the largest by ``tie``, then ``columns``.

    The newest times are found first, by a hash aggregate of two columns; only the rows of
    these times are compared as a whole.
    """
    rows = df if as_of is None else df.filter(F.col(ts) <= as_of)
    last = rows_of_newest(rows, keys, ts).groupBy(*keys).agg(F.max(F.struct(ts, *tie, *columns)).alias("__last"))
    return last.select(*keys, F.col(f"__last.{ts}").alias(ts),
                       *[F.col(f"__last.{c}").alias(c) for c in columns])


def rows_of_newest(rows: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The rows at the newest time of each series."""
    newest = rows.groupBy(*keys).agg(F.max(ts).alias("__newest")).withColumnsRenamed({k: f"__{k}" for k in keys})
    same = F.col(ts) == F.col("__newest")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(newest, same, "left_semi")


def recent_days(df: DataFrame, keys: Sequence[str], ts: str, days: int = 7) -> DataFrame:
    """Rows on the newest ``days`` distinct dates of each series.

    Dates are ranked on one row per date, then joined back, so raw rows are
    neither sorted nor gathered by series.
    """
    dated = df.withColumn("__date", floor_day(F.col(ts)))
    dates = dated.select(*keys, "__date").distinct()
    newest = Window.partitionBy(*keys).orderBy(F.col("__date").desc())
    kept = (dates.withColumn("__r", F.row_number().over(newest))
            .filter(F.col("__r") <= days).drop("__r"))
    return dated.join(kept, [*keys, "__date"], "left_semi").drop("__date")


def recent_mean(df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str],
                days: int = 7) -> DataFrame:
    return recent_days(df, keys, ts, days).groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def fallback_value(series: DataFrame, live: DataFrame, last: DataFrame, mean: DataFrame,
                   keys: Sequence[str], default: float = DEFAULT_INDEX) -> DataFrame:
    """First of live value, last known value, recent mean, default; with its source.

    ``live``, ``last`` and ``mean`` have (keys, value), one row per series.
    """
    out = series.select(*keys)
    for name, df in (("live", live), ("last_known", last), ("recent_mean", mean)):
        out = out.join(df.select(*keys, F.col("value").cast("double").alias(f"__{name}")),
                       list(keys), "left")
    source = (F.when(F.col("__live").isNotNull(), "live")
              .when(F.col("__last_known").isNotNull(), "last_known")
              .when(F.col("__recent_mean").isNotNull(), "recent_mean").otherwise("default"))
    value = F.coalesce("__live", "__last_known", "__recent_mean", F.lit(default))
    return out.select(*keys, value.alias("value"), source.alias("source"))


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str,
               columns: Sequence[str], bucket_hours: int = 24, rows_per_task: int = 500_000) -> DataFrame:
    """Newest right-hand row at or before each left-hand row.

    Both sides are cut along time, and the value carried over a cut comes from a summary
    of the right side with one row per piece. Pieces are buckets of ``bucket_hours``; one
    with many rows, of either side, is cut again at quantiles of its rows' times. What no
    cut can split, many left rows of one instant, is dealt out over salts, each with the
    right rows of its piece. So neither a long series nor a hot key meets in one task.
    """
    value = F.struct(F.col(ts).alias("__rts"), *columns)
    none = F.lit(None).cast(right.select(value.alias("v")).schema["v"].dataType)
    bucket = F.floor(hour_number(F.col(ts)) / bucket_hours)
    by, at = [*keys, "__b", "__p"], F.unix_micros(F.col(ts).cast("timestamp"))
    lookups = right.select(*keys, F.col(ts), bucket.alias("__b"), value.alias("__v"))
    probes = left.select(*keys, F.col(ts), bucket.alias("__b"), F.struct(*left.columns).alias("__left"))

    cuts = _cuts(probes, lookups, [*keys, "__b"], at, rows_per_task)
    piece = F.coalesce(F.size(F.filter("__cuts", lambda c: c <= at)), F.lit(0))
    lookups, probes = (side.join(cuts, [*keys, "__b"], "left").withColumn("__p", piece).drop("__cuts") for side in (lookups, probes))

    wanted = probes.groupBy(*by).agg(
        F.ceil(F.count(F.lit(1)) / rows_per_task).cast("int").alias("__salts"))
    newest = lookups.groupBy(*by).agg(F.max("__v").alias("__edge"))
    timeline = Window.partitionBy(*keys).orderBy("__b", "__p").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (wanted.join(newest, by, "full")
               .withColumn("__carry", F.max("__edge").over(timeline))
               .filter(F.col("__salts").isNotNull()).drop("__edge"))

    # the partition number spreads copies of one row; it is the same when a task runs again
    dealt = F.pmod(F.xxhash64("__left", F.spark_partition_id()), F.col("__salts")).cast("int")
    both = (probes.join(buckets, by).withColumn("__salt", dealt).withColumn("__v", none)
            .select(*by, ts, "__salt", "__left", "__carry", "__v")
            .unionByName(lookups.join(buckets.select(*by, "__salts"), by).select(
                *by, ts, F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)).alias("__salt"), "__v"),
                allowMissingColumns=True))
    upto = Window.partitionBy(*by, "__salt").orderBy(ts).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("__m", F.coalesce(F.max("__v").over(upto), F.col("__carry"))).filter(
        F.col("__left").isNotNull())
    return found.select("__left.*", F.col("__m.__rts").alias(f"matched_{ts}"),
                        *[F.col(f"__m.{c}").alias(c) for c in columns])


#: No bucket is cut into more pieces than this.
PIECES = 1024


def _cuts(probes: DataFrame, lookups: DataFrame, by: Sequence[str], at: Column, rows_per_task: int) -> DataFrame:
    """(by, __cuts): for buckets of too many rows, the times at which they are cut, about as many rows apart."""
    times = probes.select(*by, at.alias("__at")).unionByName(lookups.select(*by, at.alias("__at")))
    sizes = times.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > rows_per_task)
    shares = [i / PIECES for i in range(1, PIECES)]
    marks = times.join(sizes, list(by)).groupBy(*by).agg(
        F.max("__rows").alias("__rows"), F.percentile_approx("__at", shares, 10 * PIECES).alias("__marks"))
    pieces = F.least(F.lit(PIECES), F.ceil(F.col("__rows") / rows_per_task))
    chosen = F.transform(F.sequence(F.lit(1), pieces.cast("int") - 1), lambda i: F.element_at("__marks", F.ceil(i * PIECES / pieces).cast("int")))
    # written down, as a sketch of times may come out differently when it is made again
    return saved(marks.select(*by, F.array_distinct(chosen).alias("__cuts")), "as-of-cuts")


def known(requested: DataFrame, registered: DataFrame, on: Sequence[str]) -> DataFrame:
    return requested.join(registered.select(*on), list(on), "left_semi")


def unknown(requested: DataFrame, registered: DataFrame, on: Sequence[str]) -> DataFrame:
    return requested.join(registered.select(*on), list(on), "left_anti")
