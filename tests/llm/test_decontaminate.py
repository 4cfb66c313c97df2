"""Leaks against a plain edit-distance search, and the defined edge cases."""

import random

import pytest

from hourgrid.llm import decontaminate as d

SF = "/root/testdata/sf0.01"


def least_edits(pattern, text):
    """Edits of the best occurrence of the pattern anywhere in the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def damaged(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyzq")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("xyzq"))
    return "".join(chars)


def random_text(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_as_plain_search(seed):
    rng = random.Random(seed)
    items = [(i, random_text(rng, rng.randint(6, 30))) for i in range(6)]
    index = d.build_index(items, window=90)
    texts = []
    for _ in range(40):
        i, t = rng.choice(items)
        texts.append(d.normal(random_text(rng, rng.randint(0, 20)) + " " + damaged(rng, t, rng.randint(0, 16)) + " "
                              + random_text(rng, rng.randint(0, 20))))
    got = d.matches(index, texts)
    want = {(n, item) for n, text in enumerate(texts) for pattern, item, k, _ in index.patterns
            if least_edits(pattern, text) <= k}
    assert set(got) == want and len(want) > 10
    for (n, item), (start, end, edits, _) in got.items():
        assert 0 <= start < end <= len(texts[n])
        assert edits == min(least_edits(p, texts[n]) for p, i, _, _ in index.patterns if i == item)


def test_span_of_a_damaged_match():
    text = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do"
    index = d.build_index([(7, text)])
    hay = "one two three " + text.replace("sit", "sxt") + " four five"
    assert d.matches(index, [hay]) == {(0, 0): [14, 14 + len(text), 1, 1]}


def test_long_texts_are_cut_with_overlap(monkeypatch):
    monkeypatch.setattr(d, "PIECE", 300)
    rng = random.Random(4)
    item = random_text(rng, 40)
    index = d.build_index([(0, item)])
    for lead in range(0, 600, 41):
        text = d.normal("x" * lead + " " + item + " tail " * 90)
        got = d.matches(index, [text, "", text])
        assert {k: v[2] for k, v in got.items()} == {(0, 0): 0, (2, 0): 0}


def test_whole_table_exact_passages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.id, r.item): r for r in d.leaks(docs, bench, block_bytes=4000).collect()}
    items = {r.item_id: d.normal(r.text) for r in bench.collect()}
    exact = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in d.normal(r.text)}
    assert exact and exact <= set(got)
    texts = {r.doc_id: d.normal(r.text) for r in docs.collect()}
    for key in set(got) - exact:  # the others hold a window of the item within the budget
        index = d.build_index([(key[1], items[key[1]])])
        assert any(least_edits(p, texts[key[0]]) <= k for p, _, k, _ in index.patterns)


def test_edge_cases(spark):
    item = "the quick brown fox jumps over the lazy dog and runs far away"
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "a"), (3, " \n", "a"), (4, item.upper().replace(" ", "\n"), "a"), (None, "x " + item, "a"),
         (6, "pre " + item + " post", "a"), (6, "pre " + item + " post", "a"), (7, "word " * 60_000 + item, "a"),
         (8, "the quick brown fox", "a")], "doc_id long, text string, item string")
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "the"), (None, "word word word word word w")],
                                  "item_id long, text string")
    got = sorted((str(r.id), str(r.item), r.edits) for r in d.leaks(docs, bench).collect())
    assert got == [("4", "1", 0), ("6", "1", 0), ("6", "1", 0), ("7", "1", 0), ("7", "None", 0), ("None", "1", 0)]
    assert d.leaks(docs, bench.limit(0)).count() == 0 and d.leaks(docs.limit(0), bench).count() == 0


def test_no_match_over_the_border_of_two_texts(spark):
    """Two texts that hold half an item each, as neighbours or not, hold none."""
    rng = random.Random(8)
    items = [(i, random_text(rng, 30)) for i in range(5)] + [(5, "a short item"), (6, "tiny")]
    data = []
    for i, item in items[:5]:
        half = len(item) // 2
        data += [(10 * i, random_text(rng, 9) + " " + item[:half]), (10 * i + 1, item[half:] + " " + random_text(rng, 9))]
        data += [(10 * i + 2, item[:-6]), (10 * i + 3, item[4:]), (10 * i + 4, "x" + item + "\x00")]
    data += [(90, "this is a short item, here"), (91, "tiny")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = []
    for parts in (1, 7, 200):
        docs = spark.createDataFrame(data, "doc_id long, text string").repartition(parts).sortWithinPartitions("doc_id")
        rows = sorted(tuple(r) for r in d.leaks(docs, bench).collect())
        kept = {r.doc_id for r in d.without_leaks(docs, bench).collect()}
        assert kept == {i for i, _ in data} - {r[0] for r in rows}
        found.append(rows)
    assert found[0] == found[1] == found[2]
    texts = dict(data)
    assert {r[0] for r in found[0]} == {10 * i + j for i in range(5) for j in (2, 3, 4)} | {90}
    assert all(0 <= start < end <= len(d.normal(texts[i])) for i, _, start, end, *_ in found[0])
