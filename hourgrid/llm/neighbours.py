"""Approximate nearest neighbours by inner product with a permutation index.

A vector is represented by its nearest pivots in order. Vectors are dealt to shards, and
every shard posts its vectors in one inverted file per pivot, with the pivot's rank in
the vector's order. A query reads the files of its own nearest pivots, adds up the
footrule distance (rank differences; a pivot that a vector does not post counts as the
rank behind the last), takes the best of every shard and ranks those again by the exact
inner product.

Largest inner products become nearest neighbours by one more coordinate that gives all
indexed vectors the norm of the longest.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import travels_by_value
from hourgrid.session import saved

travels_by_value(__name__)

#: Pivots, a bounded sample of distinct vectors; and how many of them a vector posts.
PIVOTS = 256
POSTED = 128
#: Share of a shard's vectors that are ranked again exactly, at any size.
SHARE = 0.3
#: Vectors in a shard and queries in a block, about.
SHARD = 8192
BLOCK = 1024


class Index(NamedTuple):
    """(shard, id, vec, order) of every indexed vector, and what made the orders."""

    table: DataFrame
    pivots: np.ndarray
    shards: int
    posted: int
    rows: int


def usable(vec: Column) -> Column:
    """Whether a vector takes part: not null or zero, all components finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): usable vectors of the commonest length, one for each id (the least, if ids repeat)."""
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vec")))
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = sizes[0]["size"] if sizes else 0
    return rows.filter(F.size("vec") == size).groupBy("id").agg(F.min("vec").alias("vec"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def orders(vecs: np.ndarray, pivots: np.ndarray, longest: float, posted: int, query: bool) -> np.ndarray:
    """The nearest pivots of every vector, nearest first."""
    extra = np.zeros(len(vecs)) if query else np.sqrt(np.maximum(0.0, longest ** 2 - (vecs * vecs).sum(axis=1)))
    near = vecs @ pivots[:, :-1].T + extra[:, None] * pivots[:, -1]
    return np.argsort(-near, axis=1, kind="stable")[:, :posted].astype(np.int16)


def build(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = PIVOTS,
          posted: int = POSTED, shard: int = SHARD) -> Index:
    """Index every usable vector. Pivots are the distinct vectors that come first by a hash."""
    rows = saved(vectors(table, id_col, vec_col), "vectors")
    n, longest = rows.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)))).first()
    longest = longest or 0.0
    picked = rows.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec").limit(pivots).collect()
    base = np.array([r.vec for r in picked], np.float64) if picked else np.empty((0, 0))
    extra = np.sqrt(np.maximum(0.0, longest ** 2 - (base * base).sum(axis=1)))
    base = np.concatenate([base, extra[:, None]], axis=1)
    posted = min(posted, len(base))
    shards = n // shard + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = orders(_matrix(batch.column("vec")), base, longest, posted, query=False)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([r.tobytes() for r in found], pa.binary())], ["shard", "id", "vec", "order"])

    dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), "id", "vec")
    indexed = saved(dealt.mapInArrow(run, "shard long, id long, vec array<double>, order binary"), "permutations")
    return Index(indexed, base, shards, posted, n)


def files(order: np.ndarray, pivots: int) -> np.ndarray:
    """The inverted files of a shard: a row for each pivot with every vector's rank of it."""
    posted = order.shape[1]
    out = np.full((pivots, len(order)), posted, np.int16)
    out[order.T, np.arange(len(order))] = np.arange(posted, dtype=np.int16)[:, None]
    return out


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def search(index: Index, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best vectors found for each query, best first.

    ``score`` is the inner product in double precision, ties go to the smaller id; a
    query's own id is no candidate. Queries with fewer candidates get them all. Null
    ids, and vectors that are null, zero, of another length than most, or hold null or
    non-finite components take no part on either side; an id that repeats counts once,
    with the least of its vectors. Equal vectors are candidates each. No usable vectors
    give no rows. Columns not named are not read.
    """
    asked = vectors(queries, id_col, vec_col)
    blocks = asked.count() // block + 1
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks))).withColumn(
        "shard", F.explode(_numbers(index.shards)))
    posts = index.table.withColumn("block", F.explode(_numbers(blocks)))
    pivots, posted = index.pivots, index.posted
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def find(_key, shard: pa.Table, asks: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if shard.num_rows and asks.num_rows:
            ids = shard.column("id").to_numpy()
            by_id = np.argsort(ids, kind="stable")  # ties, of footrule too, go to the smaller id
            ids, vecs = ids[by_id], _matrix(shard.column("vec"))[by_id]
            order = np.frombuffer(b"".join(shard.column("order").to_pylist()), np.int16).reshape(len(ids), -1)[by_id]
            ranks, own = files(order, len(pivots)), _matrix(asks.column("vec"))
            if own.shape[1] != vecs.shape[1]:
                return pa.table(out, schema)
            again = max(int(share * len(ids)) + 1, k + 1)
            steps = np.arange(posted, dtype=np.int16)[:, None]
            for query, q, near in zip(asks.column("id").to_pylist(), own, orders(own, pivots, 0.0, posted, query=True)):
                if again < len(ids):
                    footrule = np.abs(ranks[near] - steps).sum(axis=0, dtype=np.int32)
                    best = np.sort(np.argsort(footrule, kind="stable")[:again])
                else:
                    best = np.arange(len(ids))
                best = best[ids[best] != query]
                scores = (vecs[best] * q).sum(axis=1)
                first = np.argsort(-scores, kind="stable")[:k]
                out["query_id"] += [query] * len(first)
                out["vec_id"] += ids[best[first]].tolist()
                out["score"] += scores[first].tolist()
        return pa.table(out, schema)

    found = posts.groupBy("block", "shard").cogroup(asked.groupBy("block", "shard")).applyInArrow(
        find, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
