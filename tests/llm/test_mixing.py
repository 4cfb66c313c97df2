"""Targets, subset sums and mixes against brute force, and the defined edge cases."""

import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from hourgrid.llm import mixing

SF = "/root/testdata/sf0.01"


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight, stop at the caps, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, rest = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in target]
        if not free:
            return target
        level = rest / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            rest -= target[s]


def check(spark, data, **extra):
    got = mixing.mix(spark.createDataFrame(data, "doc_id long, text string, source string"), **extra).collect()
    assert len(got) == len(data)
    sizes, taken, per = defaultdict(int), defaultdict(int), {}
    for _, text, source in data:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    for s in sizes:
        per[s] = taken[s] - want[s]
    return got, per


def test_whole_table(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    got, off = check(spark, data)
    assert all(abs(x) <= 60 for x in off.values()) and sorted(map(abs, off.values()))[len(off) // 2] <= 1
    again, _ = check(spark, random.Random(1).sample(data, len(data)))
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_many_of_one_size(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED", 10)
    data = [(i, "a b c", "hot") for i in range(400)] + [(1000 + i, "x y z w", "b") for i in range(200)]
    _, off = check(spark, data)
    assert all(abs(x) <= 4 for x in off.values())


def test_edge_cases(spark):
    data = [(1, None, "a"), (2, "", "a"), (3, "one two", None), (4, "w " * 50_000, "é"), (None, "x y z", "a"), (None, None, None),
            (5, "p q", "Z"), (5, "p q", "Z"), (6, " \n", "only blank")]
    check(spark, data)
    got, _ = check(spark, [(1, None, "a"), (2, "", "b")])
    assert {(r.target, r.taken) for r in got} == {(0.0, 0)}
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string, size int, taken int")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_targets_by_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 40, 1000, 30_000]) for i in range(rng.randint(1, 9))} | {None: 7}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = plain_targets(sizes)
    assert got == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("seed", range(20))
def test_knapsack_is_best(seed):
    rng = random.Random(seed)
    sizes = np.array(rng.sample(range(0, 25), 4))
    counts = np.array([rng.randint(0, 4) for _ in sizes])
    budget = rng.randint(0, 80)
    take = mixing.knapsack(sizes, counts, budget)
    assert (take <= counts).all() and (take >= 0).all()
    sums = {int(np.dot(c, sizes)) for c in itertools.product(*(range(n + 1) for n in counts))}
    assert int(take @ sizes) == min(sums, key=lambda s: (abs(s - budget), s))


def test_fit_of_a_large_source():
    rng = np.random.default_rng(3)
    sizes, counts = np.unique(rng.integers(0, 6000, 200_000), return_counts=True)
    for share in (0.0, 0.1, 0.5, 0.999, 1.0):
        budget = int((sizes * counts).sum() * share)
        take = mixing.fit(sizes, counts, budget)
        assert (take <= counts).all() and (take >= 0).all() and int(take @ sizes) == budget
