"""Champion/challenger promotion over a table of trained versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def champion_history(versions: DataFrame, keys: Sequence[str], version: str = "version",
                     mae: str = "mae") -> DataFrame:
    """Status of every version: a version is promoted when its MAE beats all before it.

    The newest promoted version is the champion, earlier ones are retired, the
    rest are challengers. One row per trained version, so the window is small.
    """
    order = Window.partitionBy(*keys).orderBy(version)
    whole = Window.partitionBy(*keys)
    best = F.min(mae).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (versions.withColumn("champion_mae_before", best)
            .withColumn("promoted", F.col(mae) < F.coalesce(best, F.lit(float("inf"))))
            .withColumn("__last", F.max(F.when(F.col("promoted"), F.col(version))).over(whole))
            .withColumn("status", F.when(F.col(version) == F.col("__last"), "champion")
                        .when(F.col("promoted"), "retired").otherwise("challenger"))
            .drop("__last"))


def champion_lookup(series: DataFrame, history: DataFrame, keys: Sequence[str],
                    version: str = "version", mae: str = "mae") -> DataFrame:
    """Champion per registered series, infinite MAE and ``loaded = false`` without one."""
    champions = history.filter(F.col("status") == "champion").select(*keys, version, mae)
    return series.select(*keys).join(champions, list(keys), "left").select(
        *keys, version, F.coalesce(mae, F.lit(float("inf"))).alias(mae),
        F.col(version).isNotNull().alias("loaded"))


def promotion_counts(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    return history.groupBy(*keys).agg(F.count_if("promoted").alias("promoted"),
                                      F.count(F.lit(1)).alias("trained"))


def missing_champions(series: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    champions = history.filter(F.col("status") == "champion").select(*keys).distinct()
    return series.select(*keys).distinct().join(champions, list(keys), "left_anti")
