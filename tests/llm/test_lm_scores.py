"""Losses under both models against a plain version, and the defined edge cases."""

import math
from collections import Counter

import pytest

from hourgrid.llm import lm_scores

SF = "/root/testdata/sf0.01"


def brute(data, target, m=lm_scores.SMOOTHING):
    lists = [(t or "").encode().lower().split() for _, t in data]
    known = {w for x in lists for w in x}
    texts = [["<s>", *x, "</s>"] for x in lists]
    models = []
    for use in ([i in target for i, _ in data], [True] * len(data)):
        pairs, ctx, uni = Counter(), Counter(), Counter()
        for text, u in zip(texts, use):
            if u:
                pairs.update(zip(text, text[1:]))
                ctx.update(text[:-1])
                uni.update(text[1:])
        models.append((pairs, ctx, uni, sum(uni.values())))
    out = []
    for text in texts:
        row = [len(text) - 2]
        for pairs, ctx, uni, n in models:
            row.append(sum(-math.log2((pairs[v, w] + m * (uni[w] + 1) / (n + len(known) + 2)) / (ctx[v] + m))
                           for v, w in zip(text, text[1:])) / (len(text) - 1))
        out.append(row)
    return out


def check(spark, data, target, **more):
    docs = spark.createDataFrame([(*r, 0.5) for r in data], "doc_id long, text string, score double")
    ids = spark.createDataFrame([(i,) for i in target], "doc_id long")
    got = sorted(lm_scores.cross_entropy_difference(docs, ids, **more).collect(),
                 key=lambda r: (str(r.id), r.n_words, r.score))
    want = sorted(((str(i), n, t - b, t, b) for (i, _), (n, t, b) in zip(data, brute(data, set(target) - {None}))))
    assert [(str(r.id), r.n_words) for r in got] == [w[:2] for w in want]
    for r, w in zip(got, want):
        assert (r.score, r.target_loss, r.background_loss) == pytest.approx(w[2:], abs=1e-9)
    return got


def test_whole_table(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    good = [r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()]
    check(spark, data, good, pack_bytes=1 << 18, bucket_bytes=1 << 17)


def test_target_like_texts_score_lower(spark):
    data = [(i, "red apple on a green tree " * 3) for i in range(20)] + [(100 + i, "numbers and more numbers here " * 3) for i in range(20)]
    got = check(spark, data, range(10))
    assert max(r.score for r in got if r.id < 100) < min(r.score for r in got if r.id >= 100)


def test_edge_cases(spark):
    data = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (None, None), (4, "A b"), (4, "c"), (5, "w " * 60_000), (6, "é ü")]
    check(spark, data, [1, 4, None, 99], pack_bytes=1000, bucket_bytes=500)
    check(spark, data, [])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm_scores.cross_entropy_difference(empty, empty).count() == 0


def test_every_word_is_known(spark):
    """More words than any fixed vocabulary holds, all of one count: each keeps its own n-grams."""
    data = [(i, " ".join(f"w{i}x{j}" for j in range(500))) for i in range(80)] + [(80, "W1x1 w1x2")]
    want = brute(data, {1})
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = lm_scores.cross_entropy_difference(docs, docs.filter("doc_id = 1"), pack_bytes=1 << 16, bucket_bytes=1 << 16).collect()
    assert len(got) == len(want)
    for r in got:
        n, t, b = want[r.id]
        assert r.n_words == n and (r.target_loss, r.background_loss, r.score) == pytest.approx((t, b, t - b), abs=1e-9)
