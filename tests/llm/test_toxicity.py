"""Toxicity by accuracy on rows whose labels were never read, and the defined edge cases."""

import zlib

import numpy as np

from hourgrid.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score(docs, labels).collect()
    assert len(got) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(truth[r.id], r.score) for r in got if r.held_out and r.id in truth]
    y, s = np.array(held).T
    assert len(y) > 300 and y.sum() > 20
    recall, false = (s[y == 1] >= 0.5).mean(), (s[y == 0] >= 0.5).mean()
    print("held out: recall", recall, "false alarms", false)
    assert recall >= 0.9 and false <= 0.01  # a few labels mark texts without any toxic word


def make(n):
    return [(i, ("you idiot, go away " if i % 3 == 0 else "a fine day for all ") * 5 + f"word{i}") for i in range(n)]


def test_edge_cases(spark):
    data = make(200) + [(500, None), (501, ""), (None, "you idiot you idiot"), (502, "x" * 300_000), (503, "!!! ???"),
                        (7, "a fine day"), (7, "a fine day"), (504, "YOU IDI0T")]
    docs = spark.createDataFrame([(*r, "z") for r in data], "doc_id long, text string, score string")
    labels = [(i, int(i % 3 == 0), 0) for i in range(200)] + [(None, 1, 0), (3, None, 0), (3, 1, 0)]
    got = toxicity.score(docs, spark.createDataFrame(labels, "doc_id long, toxic int, id int")).collect()
    assert len(got) == len(data)
    by = {r.id: r for r in got}
    assert by[None].predicted == 1 and by[None].held_out is False and by[500].predicted == 0
    assert by[500].score == by[501].score
    assert all(by[i].predicted == int(i % 3 == 0) for i in range(0, 200) if i != 7)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.createDataFrame(make(120), "doc_id long, text string")
    rows = [(i, int(i % 3 == 0)) for i in range(120)]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in rows]
    one, two = (sorted(map(tuple, toxicity.score(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect()))
                for x in (rows, turned))
    assert one == two


def test_without_two_labels(spark):
    docs = spark.createDataFrame(make(30), "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    ones = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, ones).collect()} == {1.0}
    assert toxicity.score(docs.limit(0), ones).count() == 0


def test_features():
    x = dict(zip(toxicity.FEATURES, toxicity.features("YOU total Idi0t!! soooo", {"idiot": 3.0})))
    assert x["lexicon_rate"] == 0.25 and x["near_second_person"] == 1 and x["masked_hit_rate"] == 0.25
    assert x["shout_rate"] == 0.25 and x["repeat_rate"] == 0.25 and x["exclaim_rate"] > 0
    assert toxicity.features(None, {}) == [0.0] * len(toxicity.FEATURES)
