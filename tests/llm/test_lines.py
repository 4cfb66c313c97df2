"""Recurring line templates against a plain version, and the defined edge cases."""

import random
import re
from collections import Counter, defaultdict

from hourgrid.llm import lines

SF = "/root/testdata/sf0.01"


def brute(texts, min_docs, similarity=0.8):
    def tokens(line):
        return tuple("<*>" if re.search("[0-9]", t) else t for t in re.findall(r"[^\x20\x09-\x0D]+", line))

    def number(line):
        return lines._hash([t.encode() for t in line], len(line))

    distinct = {t: {tokens(x) for x in t.split("\n")} - {()} for t in set(texts) - {None}}
    docs, leaf = defaultdict(set), defaultdict(set)
    for name, found in distinct.items():
        for x in found:
            docs[x].add(name)
            leaf[len(x), x[:3]].add(x)

    def template(forms):
        places = [Counter() for _ in next(iter(forms))]
        for x in forms:
            for at, t in enumerate(x):
                places[at][t] += len(docs[x])
        return [max(p.items(), key=lambda i: (i[1], i[0].encode()))[0] for p in places]

    def same(x, top):
        return sum(a == b for a, b in zip(x, top))

    def members(forms, top):
        close = {x for x in forms if same(x, top) >= similarity * len(x)}
        return close if len(set().union(*(docs[x] for x in close))) >= min_docs else set()

    gone = {x for x, names in docs.items() if len(names) >= min_docs}
    for forms in leaf.values():
        forms = set(forms)
        found = len(forms) > 1 and sum(len(docs[x]) for x in forms) >= min_docs
        while found and forms:
            top = template(forms)
            found = members(forms, top)
            if not found:
                seed = max(forms, key=lambda x: (same(x, top), len(docs[x]), number(x)))
                found = members(forms, template({x for x in forms if same(x, seed) >= similarity * len(x)}))
            gone |= found
            forms -= found
    out = []
    for text in texts:
        own = (text or "").split("\n")
        drop = [tokens(x) in gone for x in own]
        kept = text if not any(drop) else "\n".join(a for a, f in zip(own, drop) if not f)
        out.append((sum(bool(tokens(x)) for x in own), sum(drop), kept))
    return out


def check(spark, data, min_docs):
    got = lines.drop_recurring_lines(spark.createDataFrame(data, "doc_id long, text string"), min_docs=min_docs,
                                     pack_bytes=1 << 17)
    want = sorted((str(i), *r[:2], str(r[2])) for (i, _), r in zip(data, brute([t for _, t in data], min_docs)))
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, str(r.text)) for r in got.collect()) == want
    return want


def test_whole_table(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sum(r[2] for r in check(spark, data, 10)) > 50


def test_variable_fields(spark):
    """Numbers and other words that vary in place; other lines of the same shape stay."""
    names = "Anna Bert Cleo Dora Emil Fritz Gabi Hans Inge Jens Kurt Lena".split()
    data = [(i, f"Posted on 2024-01-{i + 1:02} by {n} in the news room at {i}:30\n"
             + " ".join(n + w for w in "this line has words of its own and many of them".split()) + f"\nPosted on my {n} wall are {n * 2} other {n * 3} things {n} again {n * 4}") for i, n in enumerate(names)]
    want = check(spark, data, 10)
    assert [r[2] for r in want] == [1] * 12


def test_edge_cases(spark):
    foot = "all rights reserved by us"

    def body(mark):
        return " ".join(mark + w for w in "some words that no other document has".split())

    data = [(i, body(chr(97 + i)) + "\n" + foot) for i in range(12)]
    data += [(50, None), (51, ""), (52, " \n\n\t"), (None, body("zz") + "\n\n" + foot), (3, data[3][1]),
             (60, foot), (61, "w " * 100_000 + "\r\n" + foot + "\r\n"), (62, "Ä  " + foot)]
    want = check(spark, data, 10)
    assert sum(r[2] for r in want) == 16 and [r[3] for r in want if r[0] == "60"] == [""]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lines.drop_recurring_lines(empty).count() == 0


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(7, "en", 1, "x y", 5)], "n_lines long, lang string, doc_id long, text string, pack long")
    got = lines.drop_recurring_lines(df)
    assert got.columns == ["lang", "doc_id", "text", "pack", "n_lines", "n_dropped"]
    assert [tuple(r) for r in got.collect()] == [("en", 1, "x y", 5, 1, 0)]
    bare = lines.drop_recurring_lines(df, counts=False)
    assert bare.columns == df.columns and bare.collect() == df.collect()


def test_copies_count_once(spark):
    """A text in many copies keeps its lines; a line of many texts goes, whatever is left."""
    data = [(i, "one text in many copies\nwith lines of its own") for i in range(40)]
    data += [(100 + i, f"the same short line\n{chr(97 + i)}") for i in range(10)] + [(200, "the same short line")]
    want = {r[0]: r[2] for r in check(spark, data, 10)}
    assert want == {str(i): 0 for i in range(40)} | {str(100 + i): 1 for i in range(10)} | {"200": 1}


def test_random_leaves_of_several_families(spark):
    """Two to four families of lines with the same length and leading words, of any weights."""
    rng = random.Random(5)
    data = []
    for leaf in range(12):
        size = rng.randint(8, 12)
        for family in range(rng.randint(2, 4)):
            shape = [f"{chr(97 + leaf)}{chr(97 + family)}{chr(97 + i)}" for i in range(size - 3)]
            for doc in range(rng.choice([3, 8, 12, 25])):
                words = [w if rng.random() < 0.9 else rng.choice("pqrstuvw") * 3 for w in shape]
                data.append((len(data), " ".join(["go", "to", chr(97 + leaf), *words]) + "\n" + "x" * (len(data) + 1)))
    want = check(spark, data, 10)
    assert 50 < sum(r[2] for r in want) < len(data)


def test_several_templates_in_a_leaf(spark):
    """Families of one length and three leading words: behind a frequent line, and of equal weight."""
    names = "Anna Bert Cleo Dora Emil Fritz Gabi Hans Inge Jens Kurt Lena".split()
    body = "this line has words of its own and many of them"
    second = "read more about {} with your friends on any evening"
    data = [(i, " ".join(n + w for w in body.split()) + "\n" + second.format(n)) for i, n in enumerate(names)]
    data += [(100 + i, " ".join(f"z{chr(97 + i)}{w}" for w in body.split()) + "\nread more about us by the end of every week") for i in range(20)]
    got = lines.drop_recurring_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert [r.n_dropped for r in got] == [1] * 32
    shapes = "read more about {} apple moon cat oak egg quill", "read more about {} lamp boat nest dog pen fox"
    data = [(100 * k + i, " ".join(f"{n}{k}{w}".translate(str.maketrans("01", "xy")) for w in (body + " " + body).split()) + "\n" + s.format(n))
            for k, s in enumerate(shapes) for i, n in enumerate(names)]
    got = lines.drop_recurring_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert [r.n_dropped for r in got] == [1] * 24
