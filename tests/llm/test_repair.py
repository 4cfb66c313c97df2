"""Repaired conversations against exhaustive search and the SQL, and the defined edge cases."""

import hashlib
import random
import re
from itertools import product

import duckdb
import pytest

from hourgrid.llm import queries, repair
from tests.oracle import compare

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        found = BLANK.findall(text)
        out.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, lines) of the best of all edits, with at most two insertions at every place."""
    best, marks = None, faults(rows)
    letters = {"u": "user", "a": "assistant"}
    kinds = [["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for f in marks]
    inserts = ["", "u", "a", "ua", "au"]
    for edits in product(*kinds):
        for gaps in product(inserts, repeat=len(rows) + 1):
            cost, audit, lines = 0, "", []
            for i, gap in enumerate(gaps):
                cost += 5 * len(gap)
                audit += "I" * len(gap)
                lines += [(letters[g], "") for g in gap]
                if i < len(rows):
                    edit, (role, text) = edits[i], rows[i]
                    audit += edit[0]
                    cost += {"D": 2, "K": 0, "R": 1}[edit[0]] + (5 if marks[i] == "truncated" and edit != "D" else 0)
                    lines += [] if edit == "D" else [(role if edit == "K" else letters[edit[1]], text)]
            if best is not None and (cost, audit) >= best[:2]:
                continue
            if all(role for role, _ in lines) and re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in lines)):
                best = cost, audit, lines
    return best


def digest(lines):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()


def test_exhaustive_search(spark):
    rng = random.Random(4)
    convs = {c: [(rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["Yes.", "No!", "cut", " ", "Why?", "ü."]))
                 for _ in range(rng.randint(0, 3))] for c in range(80)}
    data = [(c, i, r, t) for c, rows in convs.items() for i, (r, t) in enumerate(rows)]
    rng.shuffle(data)
    frame = spark.createDataFrame(data, SCHEMA)
    got = {r.id: r for r in repair.repair(frame, spark.createDataFrame([(c,) for c in convs], "conv_id long")).collect()}
    turns = {}
    for r in repair.repaired_turns(frame).orderBy("id", "position").collect():
        turns.setdefault(r.id, []).append((r.role, r.text))
    assert set(got) == set(convs)
    for c, rows in convs.items():
        cost, audit, lines = brute(rows)
        marks = faults(rows)
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        r = got[c]
        assert (r.cost, r.audit, r.digest) == (cost, audit, digest(lines)), (c, rows)
        assert (r.blank, r.duplicate, r.truncated, r.illegal, r.gaps) == (*(marks.count(f) for f in ("blank", "duplicate", "truncated")), illegal, 0)
        assert turns.get(c, []) == lines


def test_checkpoints_do_not_change_edits():
    rng = random.Random(1)
    codes = bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 9, 13]) for _ in range(3000))
    cost, steps = repair.solve(codes)
    # a table of all vectors, without checkpoints
    table = [repair.END]
    for code in reversed(codes):
        table.append(repair.before(code, table[-1]))
    table.reverse()
    state, i, audit, spent = 0, 0, "", 0
    prices = {"D": 2, "K": 0, "R": 1}
    for name, row, after in steps:
        extra = 5 if name in "KR" and codes[i] // 4 == repair.TRUNCATED else 0
        price = 5 if name == "I" else prices[name] + extra
        at = i + (name != "I")
        assert price + table[at][after] == table[i][state] and row == (-1 if name == "I" else i)
        spent, i, state, audit = spent + price, at, after, audit + name
    assert spent == cost == table[0][0] and i == len(codes) and len(re.sub("I", "", audit)) == 3000


def test_edge_cases(spark):
    long_text = "word " * 200_000 + "end."
    data = [(1, None, "user", "late?"), (1, 5, None, None), (1, 5, "assistant", "Yes."), (2, 0, "user", long_text), (2, 1, "assistant", "A."),
            (3, 7, "user", "Same."), (3, 7, "user", "Same."), (3, 9, "assistant", "Other."), (None, 1, "user", "Null id."), (None, 2, "assistant", "B."),
            (4, None, "user", "x."), (4, None, "assistant", "x.")]
    frame = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 as kind", "2 as copies", "'c' as conv", "true as new")
    got = {r.id: r for r in repair.repair(frame).collect()}
    assert (got[1].audit, got[1].gaps, got[1].blank, got[1].illegal) == ("KDK", 0, 1, 2)
    assert (got[2].audit, got[2].digest) == ("KK", digest([("user", long_text), ("assistant", "A.")]))
    assert (got[3].audit, got[3].duplicate, got[3].gaps, got[3].illegal) == ("KDK", 1, 1, 1)
    assert got[None].audit == "KK" and got[4].gaps == 0 and got[4].cost <= 4
    none = repair.repair(spark.createDataFrame([], SCHEMA), spark.createDataFrame([(9,)], "conv_id long")).collect()
    assert [tuple(r) for r in none] == [(9, 0, 0, 0, 0, 0, 0, "", EMPTY)]
    assert repair.repair(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("parts", [1, 7, 60])
def test_query_equals_sql(spark, tmp_path, parts):
    rng = random.Random(parts)
    data = [(c if c else None, rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", None, "x"]),
             rng.choice(["One.", "Two!", "three", None, "", "Four.. "])) for c in range(12) for _ in range(rng.randint(1, 9))]
    # rows of one turn go by role and the text's digest, in the SQL too; a long conversation crosses checkpoints
    data += [(99, i, rng.choice(["user", "assistant"]), f"{i}{rng.choice('.!x')}") for i in range(150)]
    spark.createDataFrame(data, SCHEMA).repartition(parts).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert compare(queries.QUERIES["op11_conversation_repair"](spark, str(tmp_path)), con, queries.REPAIR_SQL) is None
