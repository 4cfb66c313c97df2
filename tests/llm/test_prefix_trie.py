"""Nodes of tries against a plain version, whatever the cut and the shards, and the defined edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from hourgrid.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(data, family=5):
    own = {}
    for conv, turn, role, text in data:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0), tie, role, text))
    own = {c: [r[2:] for r in sorted(rows, key=lambda r: r[:2])] for c, rows in own.items()}
    rebuilt = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - c % family, [])[:h] + rows[h:])
    members = {}
    for c, rows in rebuilt.items():
        for d in range(len(rows) + 1):
            members.setdefault(rows[:d], []).append(c)
    out = set()
    for node, convs in members.items():
        under = [n for n in members if n[:len(node)] == node]
        children = [n for n in under if len(n) == len(node) + 1]
        leaves = [n for n in under if not any(m[:len(n)] == n and len(m) > len(n) for m in under)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in under if n)
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == node)
        out.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children), len(leaves), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations(seed, n=150):
    rng = random.Random(seed)
    return [(c, rng.choice([None, t, t]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "common"]))
            for c in range(n) for t in range(rng.choice([1, 2, 3, 6, 12]))]


@pytest.mark.parametrize("bound, shard_nodes, parts", [(None, 10, 3), (0, 7, 1), (3, 5, 20), (10 ** 9, 10, 7)])
def test_nodes(spark, bound, shard_nodes, parts):
    data = conversations(parts)
    got = prefix_trie.trie(spark.createDataFrame(data, SCHEMA).repartition(parts), bound=bound, shard_nodes=shard_nodes)
    rows = [tuple(r) for r in got.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(data)


def test_edge_cases(spark):
    text = "long " * 300_000
    data = [(None, 1, "user", "no number"), (7, 0, None, None), (7, 0, None, None), (-3, 2, "user", text), (5, 1, "user", text),
            (5, None, "system", "first")] + [(100, t, "user", "deep") for t in range(700)]
    rows = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 as high", "'x' as family", "2 as digest")
    got = prefix_trie.trie(rows)
    assert {tuple(r) for r in got.collect()} == brute(data) and got.columns == list(COLUMNS)
    whole = prefix_trie.trie(rows, family=1)
    assert whole.agg({"depth": "max"}).first()[0] == 700
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_same_joined_text_is_no_same_turn(spark):
    data = [(0, 0, "ab", "c"), (5, 0, "a", "bc"), (10, 0, "ab", "c")]
    assert {tuple(r) for r in prefix_trie.trie(spark.createDataFrame(data, SCHEMA)).collect()} == brute(data)


def test_perfect_hash():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 50_000):
        high, low = rng.integers(0, 4, n, dtype=np.uint64), np.arange(n, dtype=np.uint64)
        table = prefix_trie.PerfectHash(high, low)
        assert sorted(table.slots(high, low).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        prefix_trie.PerfectHash(np.zeros(2, np.uint64), np.zeros(2, np.uint64))
