"""Complete hourly grids and directional fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.functions.timefns import floor_day, hour_number


def grid_bounds(df: DataFrame, keys: Sequence[str], ts: str, keep_last: bool = False) -> DataFrame:
    """First and last grid hour per series: whole days around the data.

    The last hour is one hour before the next midnight at or after the newest
    row, so a series that ends exactly at midnight loses that row; with
    ``keep_last`` its whole day is kept instead.
    """
    day = F.expr("INTERVAL 1 DAY")
    last_day = floor_day(F.col("__max"))
    if keep_last:
        stop = last_day + day
    else:
        stop = F.when(last_day == F.col("__max"), last_day).otherwise(last_day + day)
    return (df.groupBy(*keys).agg(F.min(ts).alias("__min"), F.max(ts).alias("__max"))
            .select(*keys, floor_day(F.col("__min")).alias("grid_start"),
                    (stop - F.expr("INTERVAL 1 HOUR")).alias("grid_end"))
            .filter(F.col("grid_end") >= F.col("grid_start")))


def hours_between(bounds: DataFrame, keys: Sequence[str], out: str = "ts") -> DataFrame:
    """All hours from grid_start to grid_end, made in two narrow steps (days, then hours)."""
    days = bounds.select(*keys, F.explode(F.sequence(
        F.col("grid_start"), F.date_trunc("day", F.col("grid_end")).cast("timestamp_ntz"),
        F.expr("INTERVAL 1 DAY"))).alias("__day"))
    return days.select(*keys, F.explode(F.sequence(
        F.col("__day"), F.col("__day") + F.expr("INTERVAL 23 HOURS"),
        F.expr("INTERVAL 1 HOUR"))).alias(out))


def hourly_grid(df: DataFrame, keys: Sequence[str], ts: str = "ts",
                keep_last: bool = False) -> DataFrame:
    """Put every series on its complete hourly grid; missing hours have NULL values.

    ``df`` has at most one row per key and hour. The grid carries the keys, so
    nothing needs a forward fill.
    """
    grid = hours_between(grid_bounds(df, keys, ts, keep_last), keys, ts)
    return grid.join(df, [*keys, ts], "left")


def grid_gaps(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """Grid size, hours with data and missing hours per series.

    Counted from the bounds; the grid itself is never made.
    """
    bounds = grid_bounds(df, keys, ts)
    size = (hour_number(F.col("grid_end")) - hour_number(F.col("grid_start")) + 1)
    seen = (df.join(bounds, list(keys)).filter(F.col(ts) <= F.col("grid_end"))
            .groupBy(*keys).agg(F.count(value).alias("present_hours")))
    return (bounds.withColumn("grid_hours", size).join(seen, list(keys), "left")
            .select(*keys, "grid_start", "grid_end", "grid_hours",
                    F.coalesce("present_hours", F.lit(0)).alias("present_hours"))
            .withColumn("missing_hours", F.col("grid_hours") - F.col("present_hours")))


def directional_fill(df: DataFrame, keys: Sequence[str], ts: str, column: str, out: str,
                     backward: bool = False, bucket_hours: int = 720) -> DataFrame:
    """Forward or backward fill along time.

    A series is cut into time buckets that are filled independently; the value
    carried over a bucket edge comes from a summary with one row per bucket. So
    one long series uses many tasks, and every frame runs from its start to the
    current row (Spark evaluates those in linear time).
    """
    sign = -1 if backward else 1
    sliced = df.withColumn("__h", hour_number(F.col(ts))).withColumn(
        "__b", F.floor(F.col("__h") / bucket_hours))
    by = [*keys, "__b"]
    last_present = F.when(F.col(column).isNotNull(), F.col("__h") * sign)
    summary = sliced.groupBy(*by).agg(F.max_by(column, last_present).alias("__edge"))
    buckets = Window.partitionBy(*keys).orderBy(F.col("__b") * sign)
    carry = summary.select(*by, F.last("__edge", True).over(
        buckets.rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"))
    inside = Window.partitionBy(*by).orderBy(F.col("__h") * sign)
    local = F.last(column, True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (sliced.join(carry, by, "left")
            .withColumn(out, F.coalesce(local, F.col("__carry")))
            .drop("__h", "__b", "__carry"))
