"""Mixing sources to target weights by fitting subset sums.

Every source gets a budget of words. Whole copies of the source are taken as long as they
fit; the rest of the budget is met by taking some documents once more. Documents of the
same size are alike for that, so they are counted by exact size: a seeded share of every
size is taken first, and a bounded-knapsack dynamic programme over the counts left fits
what remains of the budget, to the word if any choice of documents does. Which documents
of a size are taken follows a seeded hash of their ids.

What a source's fit holds are its distinct sizes, never its documents.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import travels_by_value, word_count
from hourgrid.session import saved

travels_by_value(__name__)

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
#: Words of a budget that are left to the dynamic programme, at least.
TAIL = 1 << 16
#: Documents of one size and source that are put in order together, about.
RANKED = 1000


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code-point order, null last, weigh ``weights`` in turn. They share the sum
    of all sizes by weight; a target above ``most`` times its source's size stops there,
    and the excess is shared among the others by weight until none is above. In closed
    form: with the sources by rising ratio of cap to weight, those that stop are a prefix
    of the list. The windows are over sources, not documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("w", F.element_at(
        cycle, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))).withColumn(
        "cap", most * F.col("source_size").cast("double"))
    ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    # the level if exactly the sources before this one stop; the first that it suits gives it
    levels = ranked.withColumn("level", level).withColumn("suits", F.col("level") * F.col("w") <= F.col("cap"))
    chosen = levels.withColumn("found", F.min(F.when(F.col("suits"), F.struct(
        (F.col("cap") / F.col("w")).alias("r"), F.coalesce("source", F.lit("")).alias("s"), "level"))).over(whole))
    return chosen.select("source", "source_size", F.least(
        F.col("cap"), F.coalesce(F.col("found.level") * F.col("w"), F.col("cap"))).alias("target"))


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, tail: int = TAIL) -> np.ndarray:
    """How many documents of each size to take so that their sizes sum to the budget, or near it.

    Takes the same share of every size first, then single documents from the largest
    size down, and leaves about ``tail`` words to the dynamic programme.
    """
    take = np.zeros(len(sizes), np.int64)
    use = np.flatnonzero(sizes > 0)
    total = int((sizes[use] * counts[use]).sum())
    if total <= budget:
        take[use] = counts[use]
        return take
    share = max(0.0, (budget - 2 * tail) / total)
    take[use] = np.floor(counts[use] * share).astype(np.int64)
    left = budget - int((sizes * take).sum())
    for i in use[np.argsort(-sizes[use], kind="stable")]:
        n = min(int(counts[i] - take[i]), max(0, left - tail) // int(sizes[i]))
        take[i] += n
        left -= n * int(sizes[i])
    return take + knapsack(sizes, counts - take, left)


def knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Counts whose sizes sum nearest to the budget, below rather than above (bounded subset sum).

    Sizes are tried in order in bundles of 1, 2, 4, ... documents; for every sum the
    bundle that first reached it is kept, so the choice can be read backwards.
    """
    use = np.flatnonzero((sizes > 0) & (counts > 0) & (sizes <= 2 * budget))
    top = min(2 * budget, budget + int(sizes[use].max(initial=0)))  # beyond twice the budget, nothing is nearer
    first = np.full(top + 1, -1, np.int64)
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    bundles: list[tuple[int, int, int]] = []
    for i in use:
        n, bundle = min(int(counts[i]), top // int(sizes[i])), 1
        while n and not reached[budget]:
            bundle = min(bundle, n)
            words = bundle * int(sizes[i])
            new = np.flatnonzero(~reached[words:] & reached[:top + 1 - words]) + words
            reached[new] = True
            first[new] = len(bundles)
            bundles.append((int(i), bundle, words))
            n -= bundle
            bundle *= 2
    take = np.zeros(len(sizes), np.int64)
    sums = np.flatnonzero(reached)
    at = int(sums[np.abs(sums - budget).argmin()])
    while at:
        i, bundle, words = bundles[first[at]]
        take[i] += bundle
        at -= words
    return take


def mix(docs: DataFrame, id_col: str = "doc_id", size: Column | None = None, text_col: str = "text",
        source_col: str = "source", weights: Sequence[float] = WEIGHTS, most: int = MAX_COPIES, seed: int = 42) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken): how often every row goes into the mix.

    ``size`` defaults to the number of words of the text (0 for null). ``taken`` is
    copies * size, at most ``most`` times the size; over a source it sums to its target
    as near as whole documents allow. The same input and seed give the same mix.

    Null sources are a source of their own, after all others. Rows of size 0 (null,
    empty and blank texts) have no copies beyond those of the whole source. Rows with the same id
    count each; identical rows are taken in some order among themselves, which leaves the
    multiset of results the same. Null ids are in order like any other. If all sizes are
    0 so are all targets. No rows give no rows. Columns not named are not read.
    """
    size = word_count(F.col(text_col)) if size is None else size
    rows = saved(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size")), "mixing-sizes")
    counts = saved(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mixing-counts")
    goals = saved(targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
                          weights, most), "mixing-targets")

    def plan(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("size")
        sizes, n = frame["size"].to_numpy(np.int64), frame["n"].to_numpy(np.int64)
        total, target = int((sizes * n).sum()), int(round(frame["target"].iloc[0]))
        whole = min(target // total, most) if total else 0
        extra = fit(sizes, n, target - whole * total) if whole < most else np.zeros(len(n), np.int64)
        return frame.assign(whole=whole, extra=extra)[["source", "size", "n", "source_size", "target", "whole", "extra"]]

    with_goal = counts.join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    plans = saved(with_goal.groupBy("source").applyInPandas(
        plan, "source string, size long, n long, source_size long, target double, whole long, extra long"), "mixing-plans")

    # of each size: slots by a seeded hash, in order of the slot's own number; whole slots first
    keyed = rows.withColumn("key", F.xxhash64(F.lit(seed), F.col("id").cast("string"), "size"))
    planned = keyed.join(plans.withColumnsRenamed({"source": "s", "size": "z"}),
                         F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z")
    slotted = planned.withColumn("slot", F.pmod("key", F.ceil(F.col("n") / RANKED)))
    partly = (F.col("extra") > 0) & (F.col("extra") < F.col("n"))
    slots = slotted.filter(partly).groupBy("source", "size", "slot", "extra").agg(F.count("*").alias("in_slot"))
    before = Window.partitionBy("source", "size").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    room = slots.withColumn("room", F.col("extra") - F.coalesce(F.sum("in_slot").over(before), F.lit(0)))
    cut = room.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("slot").alias("t"), "room", "in_slot")
    joined = slotted.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
                          & (F.col("slot") == F.col("t")), "left")
    edge = (F.col("room") > 0) & (F.col("room") < F.col("in_slot"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "slot").orderBy("key", "id"))
    inside = joined.filter(edge).withColumn("more", (rank <= F.col("room")).cast("long"))
    outside = joined.filter(~F.coalesce(edge, F.lit(False))).withColumn(
        "more", F.coalesce((F.col("room") >= F.col("in_slot")).cast("long"), (F.col("extra") >= F.col("n")).cast("long")))
    copies = F.col("whole") + F.col("more")
    return inside.unionByName(outside).select(
        "id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
