"""Partitioned Parquet stores, reports and snapshots."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.dimensions import WEATHER_COLS
from hourgrid.operators.dedupe import first_wins, upsert_first_wins


#: Beside a store lies a folder with its state, the batch being merged and the days about to replace others.
SIDE = ".store"


def _file(spark: SparkSession, path: str):
    """(file system, path) as Spark's own Hadoop configuration finds them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _file(spark, path)
    return system.exists(where)


def _read_state(spark: SparkSession, path: str) -> dict:
    """What is known of a store: its ``schema``, and ``swap`` while staged days replace stored ones."""
    system, where = _file(spark, f"{path}{SIDE}/state.json")
    if not system.exists(where):
        return {}
    stream = system.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write_state(spark: SparkSession, path: str, schema: T.StructType, swap: bool) -> None:
    """Replace a store's state, whole or not at all: a new file takes the old one's name."""
    system, new = _file(spark, f"{path}{SIDE}/state.new")
    stream = system.create(new, True)
    try:
        stream.write(bytearray(json.dumps({"swap": swap, "schema": json.loads(schema.json())}).encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    old = hadoop.Path(f"{path}{SIDE}/state.json")
    hadoop.FileContext.getFileContext(system.makeQualified(old).toUri(), spark._jsc.hadoopConfiguration()).rename(
        system.makeQualified(new), system.makeQualified(old), how)


def _typed(schema: T.StructType, partition: Sequence[str]) -> T.StructType:
    """The schema with ``date`` as a date and all other partition columns as text."""
    return T.StructType([
        T.StructField(f.name, T.DateType() if f.name == "date" else T.StringType())
        if f.name in partition else f for f in schema.fields])


def store_schema(spark: SparkSession, path: str, partition: Sequence[str] = ("city", "date")) -> T.StructType:
    """The schema a store was written with; of a store written by others, that of its files.

    Partition values are never guessed from their looks: a city "007" stays "007".
    """
    known = _read_state(spark, path)
    if known:
        return T.StructType.fromJson(known["schema"])
    return _typed(spark.read.option("mergeSchema", "true").parquet(path).schema, partition)


def read_store(spark: SparkSession, path: str, schema: T.StructType | None = None,
               partition: Sequence[str] = ("city", "date")) -> DataFrame:
    """A day-partitioned store; columns that some files lack are NULL there."""
    return spark.read.schema(schema or store_schema(spark, path, partition)).parquet(path)


def within(rows: DataFrame, since: Column | None, until: Column) -> DataFrame:
    """The days of a store up to a moment (and from another on), as a filter on its folders."""
    rows = rows.filter(F.col("date") <= F.to_date(until))
    return rows if since is None else rows.filter(F.col("date") >= F.to_date(since))


def read_weather_or_null(spark: SparkSession, path: str, like: DataFrame,
                         keys: Sequence[str]) -> DataFrame:
    """The weather store, or (no store yet) no rows with the right types."""
    if exists(spark, path):
        return read_store(spark, path)
    return like.select(*keys, *[F.lit(None).cast("double").alias(c) for c in WEATHER_COLS]).filter(F.lit(False))


def _swap(spark: SparkSession, path: str, partition: Sequence[str], ts: str, schema: T.StructType) -> None:
    """Replace the days that are staged; may be repeated any number of times."""
    staged = spark.read.schema(schema).parquet(f"{path}{SIDE}/staged")
    (staged.hint("rebalance", *partition).sortWithinPartitions(*partition, ts)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition).parquet(path))
    _write_state(spark, path, schema, swap=False)


def upsert_days(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], ts: str,
                order: Sequence[Column], partition: Sequence[str] = ("city", "date")) -> None:
    """First-wins merge of a batch into a day-partitioned store, by one writer at a time.

    Only days that the batch touches are read and replaced. The merged days are staged
    beside the store in full before any day is replaced, and the store's state says so:
    if the swap is cut short, at any point, the next call first repeats it from the
    staged days. So repeating a failed call gives the same store. Spark writes the batch,
    the staged days and the store; the state is one small file.
    """
    state = _read_state(spark, path)
    if state.get("swap"):
        _swap(spark, path, partition, ts, T.StructType.fromJson(state["schema"]))
    side = f"{path}{SIDE}"
    one = first_wins(batch.withColumn("date", F.to_date(ts)), [*keys, ts], order)
    one = one.select(*(F.col(f.name).cast(f.dataType) for f in _typed(one.schema, partition).fields))
    one.write.mode("overwrite").parquet(f"{side}/batch")
    dated = spark.read.schema(one.schema).parquet(f"{side}/batch")
    merged, schema = dated, dated.schema
    if exists(spark, path):
        known = store_schema(spark, path, partition)
        # a row for each calendar day of the batch reaches the driver, to name the folders to read
        days = [r.date for r in dated.select("date").distinct().collect()]
        stored = read_store(spark, path, known, partition).filter(F.col("date").isin(days))
        touched = dated.select(*partition).distinct()
        merged = upsert_first_wins(stored.join(touched, list(partition), "left_semi"), dated, [*keys, ts], order)
        schema = _wider(known, merged.schema)
    merged.write.mode("overwrite").parquet(f"{side}/staged")
    _write_state(spark, path, schema, swap=True)
    _swap(spark, path, partition, ts, schema)


def _wider(known: T.StructType, new: T.StructType) -> T.StructType:
    names = set(known.names)
    return T.StructType([*known.fields, *(f for f in new.fields if f.name not in names)])


def write_features(df: DataFrame, path: str, partition: Sequence[str] = ("city",)) -> None:
    df.write.mode("overwrite").partitionBy(*partition).parquet(path)


def write_ordered(df: DataFrame, path: str, by: Sequence[str], files: int | None = None) -> None:
    """Write rows in the order of ``by``: each file holds a range of it, sorted, and files follow one another.

    Ranges come from a sample of the keys, so no task sorts more than its share. Rows
    with equal keys share a file.
    """
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def read_positions(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The rows with their place, from 1 on, in the order of a folder's files and within them."""
    file = F.col("_metadata.file_path")
    rows = spark.read.parquet(path).select(
        "*", F.regexp_replace(file, "/[^/]*$", "").alias("__folder"), file.alias("__file"), F.col("_metadata.row_index").alias("__row"))
    sizes = rows.groupBy("__folder", "__file").agg(F.count(F.lit(1)).alias("__n"))  # a row a file
    earlier = Window.partitionBy("__folder").orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    return rows.join(starts, ["__folder", "__file"]).withColumn(position, F.col("__before") + F.col("__row") + 1).drop(
        "__folder", "__file", "__row", "__before")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_report(report: DataFrame, folder: str, as_of: str) -> None:
    """The evaluation report as JSON and CSV, once under its time and once as latest.

    CSV has no nested columns, so arrays and structs become JSON text there. The
    report is computed once, the other copies are made from the first.
    """
    stamp = as_of.replace("-", "").replace(":", "").replace(" ", "_")
    first = f"{folder}/evaluation_{stamp}.json"
    report.withColumn("generated_at", F.lit(as_of)).write.mode("overwrite").json(first)
    saved = report.sparkSession.read.schema(
        report.schema.add("generated_at", T.StringType())).json(first)
    flat = saved.select(*[
        F.to_json(c).alias(c) if isinstance(saved.schema[c].dataType, (T.ArrayType, T.StructType))
        else F.col(c) for c in saved.columns])
    saved.write.mode("overwrite").json(f"{folder}/evaluation_latest.json")
    for name in (f"evaluation_{stamp}.csv", "evaluation_latest.csv"):
        flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/{name}")


def write_snapshot(df: DataFrame, path: str, as_of: str) -> None:
    """The recent window a drift check looked at, with the time of the check."""
    df.withColumn("checked_at", F.lit(as_of).cast("timestamp_ntz")).write.mode("overwrite").parquet(path)


def split_range_union(historic: DataFrame, forecast: DataFrame, keys: Sequence[str], ts: str,
                      start: Column, end: Column, as_of: Column, days: int = 5) -> DataFrame:
    """Older hours from the archive, newer ones from the forecast feed, archive first on ties."""
    cutoff = as_of - F.expr(f"INTERVAL {days} DAYS")
    old = historic.filter((F.col(ts) >= start) & (F.col(ts) <= F.least(end, cutoff)))
    new = forecast.filter((F.col(ts) >= F.greatest(start, cutoff)) & (F.col(ts) <= end))
    return upsert_first_wins(old, new, [*keys, ts], [])
