"""Repeated windows against brute force, and the defined edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from hourgrid.llm import substrings
from hourgrid.llm.common import by_bucket, hash_words

SF = "/root/testdata/sf0.01"


def brute(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def check(spark, data, window=35, **sizes):
    got = substrings.repeated_substrings(spark.createDataFrame(data, "doc_id long, text string"), window=window, **sizes)
    want = sorted((str(i), *r) for (i, _), r in zip(data, brute([t for _, t in data], window)))
    assert sorted((str(r.id), r.n_words, r.n_removed, r.kept_text) for r in got.collect()) == want


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows, pack_bytes=1 << 18, bucket_runs=1 << 16)


@pytest.mark.parametrize("window", [2, 5, 6])
def test_random_texts(spark, window):
    rng = random.Random(window)
    data = [(i, " ".join(rng.choice("abäc") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    check(spark, data, window, pack_bytes=200, bucket_runs=100)


def test_edge_cases(spark):
    line = " ".join(f"w{i}" for i in range(50))
    check(spark, [(1, None), (2, ""), (3, " \n\t "), (None, line), (5, "x y " + line.replace(" ", "\n")), (6, line), (6, line),
                  (7, " ".join(f"w{i}" for i in range(34))), (8, "z" * 200_000), (9, "q " * 40), (10, line.upper())])
    assert substrings.repeated_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_very_long_words_and_texts():
    text = ("a" * 5000 + " b\n" + "cd " * 3000).encode()
    small, n = hash_words([text, b"", text], chunk=64)
    large, m = hash_words([text, b"", text])
    assert n.tolist() == m.tolist() == [3002, 0, 3002] and np.array_equal(small, large)
    assert len(set(small.tolist())) == 3


def test_buckets_take_steps_for_what_is_there():
    places = np.sort(np.random.default_rng(1).integers(0, 100_000, 5000))
    found = by_bucket(places)
    assert [b for b, _ in found] == sorted(set(places.tolist())) and by_bucket(places[:0]) == []
    assert all((places[at] == b).all() for b, at in found) and sum(at.stop - at.start for _, at in found) == 5000
