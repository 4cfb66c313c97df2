"""Recall of the permutation index against brute force, and the defined edge cases."""

import numpy as np
import pytest

from hourgrid.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>"


def truth(ids, vecs, queries, k):
    out = {}
    for q in queries:
        s = (vecs * vecs[ids == q][0]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), s[i]) for i in order]
    return out


def answer(spark, data, k=20, **sizes):
    table = spark.createDataFrame(data, SCHEMA)
    rows = neighbours.search(neighbours.build(table, **sizes), table.filter("vec_id % 20 = 0"), k=k).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert all(sorted(r.rank for r in rows if r.query_id == q) == list(range(1, len(out[q]) + 1)) for q in out)
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    pdf = table.select("vec_id", "embedding").toPandas()
    ids, vecs = pdf.vec_id.to_numpy(), np.stack(pdf.embedding).astype(np.float64)
    want = truth(ids, vecs, ids[ids % 20 == 0], 20)
    got = answer(spark, [(int(i), v.tolist()) for i, v in zip(ids, vecs)])
    assert set(got) == set(want) and recall(got, want) >= 0.95
    for q in got:
        for i, s in got[q]:
            assert s == pytest.approx(float((vecs[ids == i][0] * vecs[ids == q][0]).sum()), abs=1e-12)


def test_norms_differ_and_shards(spark):
    rng = np.random.default_rng(2)
    vecs = (rng.normal(size=(6000, 16)) * rng.uniform(0.2, 3, (6000, 1))).astype(np.float32).astype(np.float64)
    ids = np.arange(6000)
    got = answer(spark, [(int(i), v.tolist()) for i, v in zip(ids, vecs)], shard=2500)
    assert recall(got, truth(ids, vecs, ids[::20], 20)) >= 0.9


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]), (40, None), (60, [0.0, -1.0]),
            (1, [1.0, 1.0])]
    got = answer(spark, data)
    assert got == {0: [(1, 1.0), (2, 1.0), (20, 0.0), (60, 0.0)], 20: [(1, 2.0), (2, 2.0), (0, 0.0), (60, -2.0)],
                   60: [(0, 0.0), (1, -1.0), (2, -1.0), (20, -2.0)]}
    assert answer(spark, []) == {}
    assert answer(spark, [(0, [1.0])]) == {}


def test_ties_go_to_smaller_ids(spark):
    """Thousands of equal vectors, over several shards."""
    data = [(i, [1.0, 2.0]) for i in range(3000)] + [(10_000 + i, [0.1, float(i)]) for i in range(50)]
    got = answer(spark, data, k=5, shard=700)
    assert got[100][0][0] == 10_049
    only = answer(spark, data[:3000], k=5, shard=700)
    assert [i for i, _ in only[100]] == [0, 1, 2, 3, 4] and [i for i, _ in only[0]] == [1, 2, 3, 4, 5]
