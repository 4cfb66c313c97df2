"""Repair of conversation structure by a dynamic program with square-root checkpoints.

A conversation is well formed when the initials of its roles are ``(s?(ua)+)?``: nothing, or
turns of user and assistant in pairs, after one system turn perhaps. Its rows are kept, given
another role or deleted, and empty turns inserted, at the least cost; of the cheapest ways the
one whose edits' initials (D, I, K, R) are ASCII-least is taken.

The cost from every row on, for each of the four states (nothing yet, system, user, assistant),
is worked out backwards, but only the vectors at every ``sqrt(rows)``-th row are stored. Walking
forward, the vectors of one block at a time are worked out again, and in every state the least
edit that is tight, that is, whose cost and the cost after it make the stored cost, is emitted.

Whether a row repeats an earlier one is found by joins on digests, never on a whole conversation:
rows are first counted by (conversation, turn, role, digest), so no key of the join is hot. What
the program needs of a row is one code of a byte. Spark sorts each conversation's codes before
its texts, so a task reads the codes, solves, and then lets the texts stream by: it holds a byte a
row, as many as the audit it returns, and no text. That one task reads a conversation in order is
due to the result: a digest of all of its repaired text, in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain, groupby
from math import isqrt
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import batches_of, rows_of, travels_by_value

travels_by_value(__name__)

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5  # CUT: what an undeleted truncated row adds
OPEN, SYSTEM, USER, ASSISTANT = range(4)  # states: the last role so far
OTHER = 3  # a class of roles: system 0, user 1, assistant 2, other 3
ROLES = {USER: "user", ASSISTANT: "assistant"}
FOLLOWS = (USER, USER, ASSISTANT, USER)  # the state after an inserted or rerolled row
LEGAL = {(0, 1), (1, 2), (2, 1)}
WHOLE, TRUNCATED, GONE, GONE_WITH_TEXT = range(4)  # faults, as they decide about edits
NEVER = 1 << 60


def initial(role: str | None) -> int:
    return "sua".find(role[:1]) % 4 if role else OTHER


def kept_state(state: int, role: int) -> int | None:
    """The state after a kept row of a class of roles, if it may follow."""
    if role == 0:
        return SYSTEM if state == OPEN else None
    return role + 1 if role != OTHER and FOLLOWS[state] == role + 1 else None


def inserted(costs: list[int]) -> tuple[int, ...]:
    """Costs from a place on, if turns may be inserted there first (never more than two in a row)."""
    user = min(costs[USER], INSERT + costs[ASSISTANT])
    assistant = min(costs[ASSISTANT], INSERT + costs[USER])
    return min(costs[OPEN], INSERT + user), min(costs[SYSTEM], INSERT + user), user, assistant


#: Costs after the last row: it is well formed with nothing, or after an assistant.
END = inserted([0, NEVER, NEVER, 0])


def edits(code: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, state after) of the edits of a row, insertions aside, ASCII-least first."""
    fault, role = divmod(code, 4)
    yield "D", DELETE, state
    if fault <= TRUNCATED:
        extra = CUT if fault else 0
        after = kept_state(state, role)
        if after is not None:
            yield "K", KEEP + extra, after
        yield "R", REROLE + extra, FOLLOWS[state]


EDITS = [[list(edits(code, state)) for state in range(4)] for code in range(16)]


def before(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs from a row on, given those after it."""
    return inserted([min(cost + after[to] for _, cost, to in found) for found in EDITS[code]])


def solve(codes: bytes) -> tuple[int, Iterator[tuple[str, int, int]]]:
    """The least cost, and the tight edits in order: (initial, row or -1 for an insertion, state after)."""
    n = len(codes)
    width = isqrt(n) + 1
    stored, costs = {}, END
    for i in range(n, -1, -1):
        if i < n:
            costs = before(codes[i], costs)
        if i % width == 0 or i == n:
            stored[i] = costs

    def walk() -> Iterator[tuple[str, int, int]]:
        state = OPEN
        for start in range(0, n + 1, width):
            end = min(start + width, n)
            block = [stored[end]]
            for i in range(end - 1, start - 1, -1):
                block.append(before(codes[i], block[-1]))
            block.reverse()
            for i in range(start, end + (end == n)):
                now = block[i - start]
                while True:
                    least = now[state]
                    found = EDITS[codes[i]][state] if i < n else []
                    after = block[i - start + 1] if i < n else now
                    step = next(((name, to) for name, cost, to in found if name == "D" and cost + after[to] == least), None)
                    if step is None and INSERT + now[FOLLOWS[state]] == least:
                        state = FOLLOWS[state]
                        yield "I", -1, state
                        continue
                    if step is None:
                        step = next(((name, to) for name, cost, to in found if cost + after[to] == least), None)
                    if step is not None:
                        state = step[1]
                        yield step[0], i, state
                    break
            if end == n:
                return

    return costs[OPEN], walk()


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(id, summary, repaired turns) of every conversation of a task; the turns must be read before the next one.

    The summary is a dictionary that is complete once the turns have been read.
    """
    for conv, group in groupby(rows_of(batches), key=itemgetter(0)):
        codes, turns, first_text = bytearray(), [], None
        counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        least, most, distinct, last = None, None, 0, None
        for row in group:
            _, kind, turn, role, _, copies, new, blank, cut, _ = row
            if kind:
                first_text = row
                break
            if not copies:
                continue
            if turn is not None and turn != most:
                least, most, distinct = turn if least is None else least, turn, distinct + 1
            kind_of = initial(role)
            fault = GONE if blank else TRUNCATED if cut and new else WHOLE if new else GONE_WITH_TEXT
            codes.append(fault * 4 + kind_of)
            codes.extend(bytes([GONE * 4 + kind_of]) * (copies - 1))
            if blank:
                counts["blank"] += copies
            else:
                counts["duplicate"] += copies - (1 if new else 0)
                counts["truncated"] += fault == TRUNCATED
            counts["illegal"] += last is not None and (last, kind_of) not in LEGAL
            counts["illegal"] += (copies - 1) * ((kind_of, kind_of) not in LEGAL)
            last = kind_of
        cost, steps = solve(bytes(codes))
        texts = chain([first_text] if first_text else [], group)
        texts = (next(same) for _, same in groupby(texts, key=itemgetter(2, 3, 4)))
        audit = bytearray()
        summary = counts | {"gaps": 0 if least is None else most - least + 1 - distinct, "cost": cost, "audit": audit}

        def repaired(steps=steps, texts=texts, codes=codes, audit=audit) -> Iterator[tuple[str, str, str]]:
            for name, row, state in steps:
                audit += name.encode()
                if name == "I":
                    yield name, ROLES[state], ""
                    continue
                text = next(texts) if codes[row] // 4 != GONE else None
                if name != "D":
                    yield name, text[3] if name == "K" else ROLES[state], text[9]

        yield conv, summary, repaired()


def _sorted(rows: DataFrame, ids: DataFrame | None, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Codes and then texts of every conversation, each in the order of its turns, in one task."""
    def plain(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    rows = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), plain(role).alias("role"),
                       plain(text).alias("text"))
    trimmed = F.rtrim("text", F.lit(SPACES))
    rows = rows.withColumn("digest", F.unhex(F.md5("text"))).withColumn("blank", trimmed == "").withColumn(
        "cut", ~F.right(trimmed, F.lit(1)).isin(".", "!", "?"))
    counted = rows.groupBy("conv", "turn", "role", "digest", "blank", "cut").agg(F.count("*").alias("copies"))
    # first of its role and text in the conversation: no earlier turn, null being the earliest
    earliest = counted.groupBy("conv", "role", "digest").agg(
        F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("earliest"))
    firsts = earliest.select(
        F.col("conv").alias("c"), F.when(~F.col("untimed"), F.col("earliest")).alias("t"), F.col("role").alias("r"),
        F.col("digest").alias("d"), F.lit(True).alias("new"))
    same = (F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
            & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")))
    marked = counted.join(firsts, same, "left")
    codes = marked.select("conv", F.lit(0).alias("kind"), "turn", "role", "digest", "copies",
                          F.coalesce("new", F.lit(False)).alias("new"), "blank", "cut", F.lit("").alias("text"))
    texts = rows.filter(~F.col("blank")).select(
        "conv", F.lit(1).alias("kind"), "turn", "role", "digest", F.lit(1).cast("long").alias("copies"),
        F.lit(True).alias("new"), "blank", "cut", "text")
    if ids is not None:
        bare = {"kind": "0", "turn": "cast(null as long)", "role": "''", "digest": "cast('' as binary)", "copies": "0L",
                "new": "false", "blank": "false", "cut": "false", "text": "''"}
        codes = codes.unionByName(ids.select(F.col(conv).alias("conv")).distinct().select(
            "conv", *(F.expr(e).alias(c) for c, e in bare.items())))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "kind", "turn", "role", "digest")]
    return codes.unionByName(texts).repartition("conv").sortWithinPartitions(*order)


def _mapped(found: DataFrame, each: Callable[[Iterator[tuple]], Iterator[tuple]], columns: str, size: int) -> DataFrame:
    """Run ``each`` over the conversations of every task and return its rows, ids first, in batches of ``size``."""
    types = [c.split() for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            fields = [("id", first.schema.field("conv").type)]
            fields += [(name, pa.int64() if kind == "long" else pa.string()) for name, kind in types]
            yield from batches_of(each(_conversations(chain([first], batches))), fields, size)

    return found.mapInArrow(run, f"id {found.schema['conv'].dataType.simpleString()}, {columns}")


def repair(rows: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit, digest): one row a conversation.

    ``audit`` holds the edits' initials in order, ``digest`` the SHA-256 of the repaired
    ``role:text`` lines joined by newlines; ``repaired_turns`` returns the lines. Rows are
    taken by turn, null turns first; rows of one turn by role, then by the MD5 of the text
    (equal rows are thus neighbours). Each row's first fault counts: blank, duplicate (role
    and text seen earlier), truncated (does not end in ``.``, ``!`` or ``?``). ``gaps`` is
    largest turn - smallest + 1 - distinct turns. A null role or text is one space; so such a
    text is blank, and such a role, like any that does not start with s, u or a and like an
    empty one, cannot be kept. Null ids make one conversation of their own. Ids of ``ids``
    without rows, and conversations without rows, have zeros, an empty audit and the digest
    of no text. Repeated rows are duplicates. No rows give no rows. Columns other than those
    named are not read.
    """
    def each(conversations: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, summary, turns in conversations:
            digest, joint = hashlib.sha256(), b""
            for _, turn_role, turn_text in turns:
                digest.update(joint + f"{turn_role}:{turn_text}".encode())
                joint = b"\n"
            yield (conv_id, *(summary[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                   summary["audit"].decode(), digest.hexdigest())

    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    return _mapped(_sorted(rows, ids, conv, turn, role, text), each, f"{counts}, audit string, digest string", 256)


def repaired_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """(id, position, edit, role, text): the turns of every repaired conversation, from 0 on; see ``repair``."""
    def each(conversations: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, _, turns in conversations:
            for position, found in enumerate(turns):
                yield conv_id, position, *found

    return _mapped(_sorted(rows, None, conv, turn, role, text), each,
                   "position long, edit string, role string, text string", 1024)
