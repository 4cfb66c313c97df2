"""First-wins de-duplication and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key combination: the smallest by ``order``, nulls after all values.

    Of rows that tie the one with a value in the first column in which another has none.

    Written as an aggregate rather than a ranked window: every map task already
    reduces its copies to one row per key, so a key with very many copies does
    not travel through the shuffle or meet in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    sortable = [x for i, o in enumerate(order) for x in (o.isNull().alias(f"__n{i}"), o.alias(f"__o{i}"))]
    ranked = df.select(*keys, F.struct(
        *sortable, *[F.col(c).isNull().alias(f"__r{i}") for i, c in enumerate(rest)], *rest).alias("__row"))
    best = ranked.groupBy(*keys).agg(F.min("__row").alias("__row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c)
                         for c in df.columns])


def upsert_first_wins(existing: DataFrame, new: DataFrame, keys: Sequence[str],
                      order: Sequence[Column]) -> DataFrame:
    """Merge a batch into a store; a stored row always beats a new one.

    One shuffle on the keys does the anti-join, the union and the de-duplication
    together. Columns missing on either side come out as NULL.
    """
    both = (existing.withColumn("__side", F.lit(0))
            .unionByName(new.withColumn("__side", F.lit(1)), allowMissingColumns=True))
    return first_wins(both, keys, [F.col("__side"), *order]).drop("__side")


def new_rows_only(existing: DataFrame, new: DataFrame, keys: Sequence[str],
                  order: Sequence[Column]) -> DataFrame:
    """The rows of a batch an append-only store does not have yet."""
    return first_wins(new, keys, order).join(existing.select(*keys), list(keys), "left_anti")
