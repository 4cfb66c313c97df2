"""Landed records apart: those that can be used, and the others with the reason.

Every landed record is in exactly one of both tables. A record that does not parse costs
itself alone: the records of a payload are taken out as text before any of them is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.dimensions import MIN_COVERAGE_PCT, PM25_MAX, PM25_MIN
from hourgrid.functions.timefns import floor_hour, utc_wall
from hourgrid.operators.quality import canonical_name
from hourgrid.sources.schemas import MEASUREMENT_FIELDS

CORRUPT = "_corrupt"


def _first_of(reasons: Sequence[tuple[str, Column]]) -> Column:
    """The first reason whose condition holds, NULL if none does."""
    return F.coalesce(*(F.when(condition, F.lit(name)) for name, condition in reasons))


def _out_of_bounds(value: Column) -> Column:
    return ~value.between(PM25_MIN, PM25_MAX)


def judged_measurements(pages: DataFrame, keys: Sequence[str], payload: str) -> DataFrame:
    """(keys, position, record, reason, ts, pm25, coverage_pct): every record of measurement pages.

    ``record`` is its JSON text, of an unreadable payload the payload itself (position NULL).
    ``reason`` is NULL for a usable record. An empty page has no records.
    """
    listed = F.from_json(payload, "results array<string>")["results"]
    entry = "struct<position: int, record: string>"
    each = F.when(listed.isNull(), F.array(F.struct(F.lit(None).cast("int").alias("position"), F.col(payload).alias("record"))).cast(f"array<{entry}>"))
    each = each.otherwise(F.transform(listed, lambda r, i: F.struct(i.alias("position"), r.alias("record"))).cast(f"array<{entry}>"))
    rows = pages.select(*keys, F.explode(each).alias("e")).select(*keys, "e.position", "e.record")
    rows = rows.withColumn("r", F.from_json("record", f"struct<{MEASUREMENT_FIELDS}, {CORRUPT}:string>",
                                            {"columnNameOfCorruptRecord": CORRUPT}))
    rows = rows.withColumn("ts", floor_hour(utc_wall(F.try_to_timestamp(F.col("r.period.datetimeTo.utc")))))
    coverage = F.coalesce(F.col("r.coverage.percentCoverage"), F.lit(100.0))
    reason = _first_of([
        ("unreadable payload", F.col("position").isNull()),
        ("unreadable record", F.col("record").isNull() | F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()),
        ("low coverage", coverage < MIN_COVERAGE_PCT), ("flagged", F.col("r.flagInfo.hasFlags")),
        ("no value", F.col("r.value").isNull() | F.isnan("r.value")), ("no time", F.col("ts").isNull()),
        ("out of bounds", _out_of_bounds(F.col("r.value")))])
    return rows.select(*keys, "position", "record", reason.alias("reason"), "ts", F.col("r.value").alias("pm25"),
                       coverage.alias("coverage_pct"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """History files with all columns as text, and the whole line of those that do not fit the header."""
    names = spark.read.csv(path, header=True, inferSchema=False).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    return spark.read.csv(path, schema=schema, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)


def judged_history(lines: DataFrame, value: str = "PM2_5_ugm3") -> DataFrame:
    """All of ``read_lines`` with ``city``, ``timestamp`` (the hour) and ``reason``, NULL for a usable reading."""
    stamp = F.try_to_timestamp("Datetime").cast("timestamp_ntz")
    number = F.col(value).try_cast("double")
    city = canonical_name(F.col("City"))
    reason = _first_of([
        ("unreadable line", F.col(CORRUPT).isNotNull()), ("unknown city", city.isNull()), ("no time", stamp.isNull()),
        ("no value", number.isNull() | F.isnan(number)), ("out of bounds", _out_of_bounds(number))])
    judged = lines.withColumns({"reason": reason, "timestamp": floor_hour(stamp), "__city": city})
    return judged.withColumnRenamed("City", "spelling").withColumnRenamed("__city", "city")


def apart(judged: DataFrame, usable: str, rejected: str) -> None:
    """Write a judged table to two folders; the rejected records lie under their reason.

    The table is read twice, once for each folder, so that no record passes a driver or a cache.
    """
    judged.filter(F.col("reason").isNull()).drop("reason").write.mode("overwrite").parquet(usable)
    judged.filter(F.col("reason").isNotNull()).write.mode("overwrite").partitionBy("reason").parquet(rejected)
