"""License scans against a plain version, and the defined edge cases."""

import math
import re
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hourgrid.llm import licenses as lic

SF = "/root/testdata/sf0.01"


def brute(files):
    """(id, path, license, cosine, notice, is file, inherited, from, effective) without the filters by heavy words."""
    templates = [(0, *t) for t in lic.HEADERS] + [(1, *t) for t in lic.FILES]
    df = Counter(w for _, _, t in templates for w in set(lic.plain_words(t)))
    n = len(templates)
    telling = lic.Vectors(lic.HEADERS, lic.FILES).telling

    def vector(words):
        v = {w: (1 + math.log(c)) * (math.log((n + 1) / (df[w] + 1)) + 1) for w, c in Counter(words).items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()} if v else {}

    goal = [(kind, name, vector(lic.plain_words(t))) for kind, name, t in templates]

    def best(kind, unit):
        v = vector(lic.plain_words(unit))
        c, name = min((-round(sum(x * g.get(w, 0) for w, x in v.items()), 9), name) for k, name, g in goal if k == kind)
        return (name, -c) if -c >= lic.THRESHOLD else None

    memo, rows = {}, []
    for i, path, text in files:
        pieces = [p for p in re.split(lic.CUT, text or "") if re.search("[A-Za-z0-9]", p)]
        tells = [bool(telling & set(lic.plain_words(p))) for p in pieces]
        own, covered = [], set()
        for a in range(len(pieces)):
            for b in range(a, min(a + lic.GROUP, len(pieces))):
                if tells[a] and tells[b]:
                    unit = " ".join(pieces[a:b + 1])
                    if unit not in memo:
                        memo[unit] = best(0, unit)
                    if memo[unit]:
                        own.append((-memo[unit][1], memo[unit][0], unit))
                        covered |= {p for p, t in zip(pieces[a:b + 1], tells[a:b + 1]) if t}
        own = min(own, default=None)
        whole = best(1, text) if text and lic.plain_words(text) else None
        words = sum(len(lic.plain_words(p)) for p in covered)
        named = bool(re.search(lic.FILE_NAME[4:], path or "", re.I))
        is_file = bool(whole) or bool(own) and (named or words >= lic.FILE_SHARE * len(lic.plain_words(text)))
        if whole:
            own = (-whole[1], whole[0], None)
        rows.append((i, path, own, is_file, (path or "").rpartition("/")[0]))
    by_dir = {}
    for _, path, own, is_file, folder in rows:
        if is_file:
            key = (own[0], path or "", own[1])
            if folder not in by_dir or key < by_dir[folder][0]:
                by_dir[folder] = (key, own[1], path)
    out = []
    for i, path, own, is_file, folder in rows:
        while folder not in by_dir and folder:
            folder = folder.rpartition("/")[0]
        got = by_dir.get(folder, (None, None, None))
        out.append((i, path, own and own[1], own and -own[0], own and own[2], is_file, got[1], got[2], own[1] if own else got[1]))
    return out


def check(spark, files):
    got = lic.scan(spark.createDataFrame([(*f, 1) for f in files], "doc_id long, path string, text string, dir int")).collect()
    want = sorted(brute(files), key=str)
    assert len(got) == len(want)
    for r, w in zip(sorted((tuple(r) for r in got), key=str), want):
        assert r[:3] + r[4:] == w[:3] + w[4:] and r[3] == (pytest.approx(w[3]) if w[3] else None)
    return got


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    files = [tuple(r) for r in docs.select("doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")), "text").collect()]
    got = check(spark, files)
    text = {f[0]: f[2] for f in files}
    for r in got:
        assert bool(re.search("Licensed under|Released under|is licensed under|All rights reserved", text[r.id])) == (r.license is not None)


def test_inheritance_and_edge_cases(spark):
    mit, gpl = lic.HEADERS[0][1], "This work is licensed under the GNU General Public License, version 3."
    files = [(1, "a/LICENSE", mit + "\nand so on and on and on and on and on and on"), (2, "a/b/c/x.py", "code here"),
             (3, "a/b/COPYING.txt", "header\r\n  " + gpl), (4, "a/y.py", "# Licensed under the Apache License, Version 2.0\nx = 1\n" * 2),
             (5, "z/q.py", None), (6, "z/q.py", ""), (None, "a/b/d.py", " \n"), (7, None, "no path"), (8, "root.txt", "word " * 50_000),
             (9, "a/b/c/x.py", "code here"), (9, "a/b/c/x.py", "code here"), (10, "ab/c.py", "the version of the public work is general"),
             (11, "a//b/x", "double slash"), (12, "s/only.txt", "All rights reserved."), (13, "s/t/u", "RELEASED  under the MIT-License!")]
    got = {r.id: r for r in check(spark, files)}
    assert got[2].effective == got[9].effective == "GPL-3.0" and got[2].inherited_from == "a/b/COPYING.txt"
    assert got[4].license == "Apache-2.0" and got[4].inherited == "MIT" and not got[4].is_license_file
    assert got[5].effective is None and got[13].license == "MIT" and got[10].effective is None
    assert lic.scan(spark.createDataFrame([], "doc_id long, path string, text string")).count() == 0


GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""


def wrapped(text, width):
    return "\n".join(textwrap.wrap(text, width))


def test_wrapped_headers_and_whole_files(spark):
    code = "def area(width, height):\n    return width * height\n" * 30
    apache = lic.HEADERS[4][1]
    files = [(1, "p/a.py", GPL + code), (2, "p/b.py", "".join(f" * {x}\n" for x in textwrap.wrap(apache, 50)) + code),
             (3, "p/c.py", f"{code}{'alpha beta gamma ' * 20}. {lic.HEADERS[1][1]} {'delta epsilon ' * 30}"),
             (4, "p/d.py", code), (5, "q/x.py", code)]
    for n, (name, text) in enumerate(lic.FILES):
        for m, width in enumerate((40, 79)):
            files.append((100 + 10 * n + m, f"full/{n}/{m}/terms", "Copyright (c) 1998-2031 Some Person of Somewhere\n\n" + wrapped(text, width)))
            files.append((200 + 10 * n + m, f"full/{n}/{m}/src/deep/code.c", code))
    got = {r.id: r for r in check(spark, files)}
    assert got[1].license == "GPL-3.0" and got[1].cosine > 0.9 and not got[1].is_license_file
    assert got[2].license == "Apache-2.0" and got[2].cosine > 0.9 and got[3].license == "MIT" and got[4].effective is got[5].effective is None
    for n, (name, _) in enumerate(lic.FILES):
        for m in (0, 1):
            whole, below = got[100 + 10 * n + m], got[200 + 10 * n + m]
            assert whole.license == name and whole.is_license_file and whole.notice is None and whole.cosine > 0.9
            assert below.license is None and below.effective == name and below.inherited_from == f"full/{n}/{m}/terms"


def test_results_hang_on_the_file_alone(spark):
    one = check(spark, [(1, "p/a.py", GPL)])[0]
    many = check(spark, [(1, "p/a.py", GPL)] + [(i, f"q/{i}", f"general public license software foundation {i}") for i in range(2, 60)])
    assert {r.id: tuple(r) for r in many}[1] == tuple(one)


def test_hot_keys(spark):
    """One directory and one notice hold nearly all files; every one inherits, whichever way it is joined."""
    files = [(i, "hot/x", "Released under the MIT License." if i % 2 else None) for i in range(1, 400)]
    files += [(1000 + i, f"cold/{i}/x", "All rights reserved." if i % 2 else "") for i in range(6)]
    got = {r.id: r for r in check(spark, files)}
    assert got[2].effective == "MIT" and got[1000].effective is None and got[1001].effective == "Proprietary"
