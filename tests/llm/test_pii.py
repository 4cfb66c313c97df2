"""Pseudonyms by a plain Feistel network in Python, exact round trips, and the defined edge cases."""

import datetime
import hashlib
import re

from pyspark.sql import functions as F

from hourgrid.llm import pii

SF = "/root/testdata/sf0.01"
KEY = "k"


def step(by, size, kind, n):
    word = f"{KEY}|{kind}|{n}|{size}|{by}"
    return int(hashlib.sha256(word.encode()).hexdigest()[:15], 16) % size


def network(a, b, size_a, size_b, kind):
    for n in range(pii.ROUNDS):
        if n % 2 == 0:
            a = (a + step(b, size_a, kind, n)) % size_a
        else:
            b = (b + step(a, size_b, kind, n)) % size_b
    return a, b


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def plain(kind, value):
    """The pseudonym of one value, worked out without Spark."""
    digits = re.sub("[^0-9]", "", value)
    if kind == "card":
        body = digits[1:-1]
        n = len(body) // 2
        a, b = network(int(body[:n]), int(body[n:]), 10 ** n, 10 ** (len(body) - n), kind)
        out = f"{digits[0]}{a:0{n}}{b:0{len(body) - n}}"
        out += str(-luhn(out + "0") % 10)
    elif kind == "phone":
        area, code, line = int(digits[-10:-7]), int(digits[-7:-4]), int(digits[-4:])
        if code == 555:
            a, b = network(area, line, 1000, 10_000, kind)
            out = f"{a:03}555{b:04}"
        else:
            codes = [c for c in range(200, 1000) if c != 555]
            a, b = network(area * 799 + codes.index(code), line, 1000 * 799, 10_000, kind)
            out = f"{a // 799:03}{codes[a % 799]}{b:04}"
        out = digits[:-10] + out
    elif kind == "ip":
        w, x, y, z = map(int, value.split("."))
        a, b = network(w * 256 + x, y * 256 + z, 65536, 65536, kind)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    elif kind == "date":
        first = datetime.date(1700, 1, 1)
        at = (datetime.date.fromisoformat(value) - first).days
        a, b = network(at // 773, at % 773, 189, 773, kind)
        return (first + datetime.timedelta(days=a * 773 + b)).isoformat()
    new = iter(out)
    return "".join(next(new) if c.isdigit() else c for c in value)


def apply(spark, texts, **more):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r.text for r in pii.pseudonymise(df, KEY, **more).orderBy("doc_id").collect()]


def test_same_as_plain(spark):
    values = [("card", "4417744280351547"), ("card", "4417 7442 8035 1547"), ("card", "378282246310005"), ("card", "4222222222222"),
              ("phone", "+1 (487) 555-7209"), ("phone", "487-333-0000"), ("phone", "212.999.1234"), ("phone", "1 200 554 9999"),
              ("ip", "11.106.155.206"), ("ip", "0.0.0.0"), ("ip", "255.255.255.255"),
              ("date", "2024-02-29"), ("date", "1700-01-01"), ("date", "2099-12-31")]
    got = apply(spark, [f"see {v}, or ({v}) again" for _, v in values])
    assert got == [f"see {plain(k, v)}, or ({plain(k, v)}) again" for k, v in values]


def test_whole_table_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    new = pii.pseudonymise(docs, KEY)
    back = pii.pseudonymise(new.select(docs.columns), KEY, back=True)
    assert back.select(docs.columns).exceptAll(docs).isEmpty() and new.columns[:5] == docs.columns
    texts = dict(docs.select("doc_id", "text").collect())
    changed = 0
    for r in new.collect():
        cards = [c for c in re.findall(r"(?<![0-9A-Za-z])[0-9]{16}(?![0-9A-Za-z])", texts[r.doc_id]) if luhn(c) == 0]
        assert r.n_card == len(cards) and all(plain("card", c) in r.text and c not in r.text for c in cards)
        phones = re.findall(r"\+1 \([0-9]{3}\) 555-[0-9]{4}", texts[r.doc_id])
        assert r.n_phone == len(phones) and all(plain("phone", p) in r.text for p in phones)
        mails = re.findall(r"[a-z0-9.]+@[a-z0-9.]+[a-z]", texts[r.doc_id])
        assert r.n_email == len(mails) and not any(m in r.text for m in mails)
        changed += texts[r.doc_id] != r.text
        assert (texts[r.doc_id] == r.text) == (r.n_card + r.n_phone + r.n_ip + r.n_email + r.n_date == 0)
    assert changed > 10


def test_permutation(spark):
    """On a whole small range: nothing collides, and backwards undoes it."""
    df = spark.range(7 * 11).select(pii.pair(F.floor(F.col("id") / 11), F.col("id") % 11).alias("p"))
    seven, eleven = F.lit(7).cast("bigint"), F.lit(11).cast("bigint")
    there = df.select("p", pii.feistel(F.col("p"), seven, eleven, "key", "x").alias("q"))
    rows = there.select("p", "q", pii.feistel(F.col("q"), seven, eleven, "key", "x", back=True).alias("r")).collect()
    assert len({r.q for r in rows}) == 77 and all(r.p == r.r for r in rows) and sum(r.p != r.q for r in rows) > 60


def test_values_that_do_not_validate_stay(spark):
    texts = ["1234567890123456", "256.1.1.1", "2023-02-29", "1699-12-31", "13/13/2024", "a1.2.3.4", "v1.2.3.4.5", "12345678901234567890",
             "(123) 155-0000", "x@y", "@a.bc", "1.2.3", "01.2.3.4", "4417744280351547x"]
    assert apply(spark, texts) == texts


def test_edge_cases(spark):
    long = "w " * 200_000 + "11.106.155.206" + " x" * 1000 + "9" * 5000 + "a" * 5000 + "@"
    texts = [None, "", " \n\t", "no values\r\n at  all ", long, "11.106.155.206", "11.106.155.206", "Bob.Ray@x.org bob.ray@y.org"]
    got = apply(spark, texts)
    assert got[:4] == texts[:4] and got[4] == long.replace("11.106.155.206", plain("ip", "11.106.155.206"))
    assert got[5] == got[6] == plain("ip", "11.106.155.206")
    one, two = got[7].split()
    assert one.split("@")[0] == two.split("@")[0] != "bob.ray" and re.fullmatch(r"[a-z]{3}\.[a-z]{3}@x\.org", one)
    assert apply(spark, ["1/2/2023 and 3.1.2024"], back=True) != ["1/2/2023 and 3.1.2024"]
    df = spark.createDataFrame([("x", 7, "z", "a 1.2.3.4")], "value string, n_ip long, kind string, text string")
    row = pii.pseudonymise(df, KEY).first()
    assert (row.value, row.kind, row.n_ip) == ("x", "z", 1)
    assert pii.pseudonymise(spark.createDataFrame([], "text string"), KEY).count() == 0
