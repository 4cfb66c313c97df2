"""Line de-duplication with a fixed-depth tree of line templates.

As in log parsing, a line first goes to a node by its number of tokens, then by its
first ``DEPTH`` tokens; tokens with digits count as variable fields ("<*>") everywhere.
Within such a leaf the most frequent token of every place makes the leaf's template;
lines that agree with it in ``SIMILARITY`` of the places are its members, the other
places are variable fields. Where that template does not recur, it may mix several: the
line most like it then picks the lines that make the template. The members of one that
recurs are taken out and the leaf's other lines make the next, until none recurs. A
template's members together, and every masked line by itself, are templates. Lines of
templates that recur in ``MIN_DOCS`` distinct texts are dropped, however much of a text
they make up; copies of a text are told from boilerplate by counting each text once.

Masked lines are counted by (line, text) first, so a line that every document has is no
hot key, and only then by line. Only leaves that can reach the count with several masked
lines have their tokens looked at. Texts are dealt to packs by a hash; they are shuffled
for the tokens and once more for the outcome.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import text_bytes, total_bytes, travels_by_value, with_packs
from hourgrid.session import saved

travels_by_value(__name__)

DEPTH = 3
SIMILARITY = 0.8
MIN_DOCS = 10
PACK_BYTES = 4 << 20
DIGIT = re.compile(rb"[0-9]")
FIELD = b"<*>"


def masked(line: bytes) -> list[bytes]:
    """The tokens of a line, with a variable field for every token that has a digit."""
    tokens = line.split()
    if DIGIT.search(line):
        return [FIELD if DIGIT.search(t) else t for t in tokens]
    return tokens


def _hash(tokens: list[bytes], n: int) -> int:
    return xxhash.xxh64_intdigest(b" ".join(tokens), n) - (1 << 63)


def _text_hash(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def parse(line: bytes) -> tuple[int, int, list[bytes]]:
    """(leaf, masked line, tokens): the leaf hashes the token count and the leading tokens."""
    tokens = masked(line)
    return _hash(tokens[:DEPTH], len(tokens)), _hash(tokens, len(tokens)), tokens


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                         similarity: float = SIMILARITY, counts: bool = True, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """All columns, with the text without its recurring lines, ``n_lines`` and ``n_dropped``.

    Lines end at line feeds; blank lines have no tokens, count as no lines and stay. A
    line is dropped when its template occurs in at least ``min_docs`` distinct texts. A
    text all of whose lines go becomes empty. Null texts stay null with no lines; empty
    and blank texts stay. Rows with the same text count once, rows with the same id each.
    No rows give no rows. Columns named ``n_lines`` or ``n_dropped`` in the input are
    replaced; with ``counts=False`` just the columns of ``docs`` are returned, those too.
    """
    replaced = ("n_lines", "n_dropped") if counts else ()
    others = [c for c in docs.columns if c != text_col and c not in replaced]
    carried = {c: f"c{i}" for i, c in enumerate(others)}
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), *(F.col(f"`{c}`").alias(n) for c, n in carried.items()))
    total = total_bytes(rows, "text")
    rows = with_packs(rows, [carried[id_col], "text"] if id_col in carried else ["text"], total // pack_bytes + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[int, int, int, int]] = set()
            for pack, text in zip(batch.column("pack").to_pylist(), text_bytes(batch.column("text"))):
                name = _text_hash(text)
                found.update((pack, *parse(x)[:2], name) for x in text.split(b"\n") if x.strip())
            keys = np.array(list(found), np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, i]) for i in range(4)], ["pack", "leaf", "line", "doc"])

    seen = saved(rows.select("pack", "text").mapInArrow(count, "pack long, leaf long, line long, doc long"), "lines-seen")
    forms = saved(seen.select("leaf", "line", "doc").distinct().groupBy("leaf", "line").agg(F.count("*").alias("n")), "lines-forms")
    recurring = forms.filter(F.col("n") >= min_docs).select("leaf", "line")
    mixed = forms.groupBy("leaf").agg(F.sum("n").alias("docs"), F.count("*").alias("forms")).filter(
        (F.col("docs") >= min_docs) & (F.col("forms") > 1)).select("leaf")
    packs_of_mixed = seen.join(mixed, "leaf").select("pack", "leaf").distinct()

    def tokens_of(pack: pa.Table, leaves: pa.Table) -> pa.Table:
        wanted = set(leaves.column("leaf").to_pylist())
        out = {"leaf": [], "line": [], "doc": [], "tokens": []}
        for text in text_bytes(pack.column("text")) if wanted else []:
            for leaf, line, tokens in {p[1]: p for p in map(parse, text.split(b"\n")) if p[2] and p[0] in wanted}.values():
                for key, value in zip(out, (leaf, line, _text_hash(text), tokens)):
                    out[key].append(value)
        return pa.table(out, pa.schema([("leaf", pa.int64()), ("line", pa.int64()), ("doc", pa.int64()),
                                        ("tokens", pa.list_(pa.binary()))]))

    packed = rows.groupBy("pack")
    parts = saved(packed.cogroup(packs_of_mixed.groupBy("pack")).applyInArrow(
        tokens_of, "leaf long, line long, doc long, tokens array<binary>").dropDuplicates(["leaf", "line", "doc"]), "lines-mixed")
    members = _members(parts, min_docs, similarity)
    dropped = recurring.unionByName(members).distinct()
    packs_of_dropped = seen.join(dropped, ["leaf", "line"]).select("pack", "line").distinct()

    def drop(pack: pa.Table, lines: pa.Table) -> pa.Table:
        gone = set(lines.column("line").to_pylist())
        kept, n_lines, n_dropped = [], [], []
        for text in pack.column("text").cast(pa.binary()).to_pylist():
            own = [(x, parse(x) if x.strip() else None) for x in (text or b"").split(b"\n")]
            flags = [p is not None and p[1] in gone for _, p in own]
            n_lines.append(sum(p is not None for _, p in own))
            n_dropped.append(sum(flags))
            kept.append(text if not n_dropped[-1] else b"\n".join(x for (x, _), f in zip(own, flags) if not f))
        columns = {n: pack.column(n) for n in carried.values()}
        return pa.table(columns | {"text": pa.array(kept, pa.binary()).cast(pa.string()),
                                   "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())})

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{n} {kinds[n]}" for n in carried.values()) + ", text string, n_lines long, n_dropped long"
    out = packed.cogroup(packs_of_dropped.groupBy("pack")).applyInArrow(drop, schema.removeprefix(", "))
    back = {c: F.col(carried[c]).alias(c) for c in others} | {text_col: F.col("text").alias(text_col)}
    return out.select(*(back[c] for c in docs.columns if c in back), *replaced)


def _members(parts: DataFrame, min_docs: int, similarity: float) -> DataFrame:
    """(leaf, line) of the masked lines of all of a leaf's templates that recur: (leaf, line, doc, tokens) in.

    A round finds at most one template a leaf; only leaves where it recurs have another.
    """
    found = None
    while True:
        lines = saved(parts.groupBy("leaf", "line").agg(F.count("*").alias("n"), F.first("tokens").alias("tokens")), "lines-leaves")
        alike = _alike(lines, _template(lines))
        first = saved(_recurring(parts, _close(alike, similarity), min_docs), "lines-members")
        # of leaves without: the line most like the template, and the template of the lines like that one
        others = alike.join(first.select("leaf").distinct(), "leaf", "left_anti")
        seeds = others.groupBy("leaf").agg(F.max_by("line", F.struct("same", "n", "line")).alias("line"))
        seeds = lines.join(seeds, ["leaf", "line"]).select("leaf", F.posexplode("tokens").alias("at", "common"))
        voters = lines.join(_close(_alike(lines, seeds), similarity), ["leaf", "line"])
        second = _recurring(parts, _close(_alike(lines, _template(voters)), similarity), min_docs)
        new = saved(first.unionByName(second), "lines-members")
        found = new if found is None else found.unionByName(new)
        if new.isEmpty():
            return found
        parts = saved(parts.join(new.select("leaf").distinct(), "leaf", "left_semi").join(new, ["leaf", "line"], "left_anti"),
                      "lines-left")


def _template(lines: DataFrame) -> DataFrame:
    """(leaf, at, common): the most frequent token of every place."""
    places = lines.select("leaf", "n", F.posexplode("tokens").alias("at", "token")).groupBy("leaf", "at", "token").agg(
        F.sum("n").alias("n"))
    return places.groupBy("leaf", "at").agg(F.max_by("token", F.struct("n", "token")).alias("common"))


def _alike(lines: DataFrame, template: DataFrame) -> DataFrame:
    """(leaf, line, n, size, same): in how many places a line agrees with its leaf's template."""
    placed = lines.select("leaf", "line", "n", F.size("tokens").alias("size"), F.posexplode("tokens").alias("at", "token"))
    return placed.join(template, ["leaf", "at"]).groupBy("leaf", "line", "n", "size").agg(
        F.sum((F.col("token") == F.col("common")).cast("int")).alias("same"))


def _close(alike: DataFrame, similarity: float) -> DataFrame:
    return alike.filter(F.col("same") >= similarity * F.col("size")).select("leaf", "line")


def _recurring(parts: DataFrame, close: DataFrame, min_docs: int) -> DataFrame:
    """The lines of ``close`` whose leaf has them in enough documents."""
    docs = parts.select("leaf", "line", "doc").join(close, ["leaf", "line"]).groupBy("leaf").agg(
        F.count_distinct("doc").alias("docs")).filter(F.col("docs") >= min_docs).select("leaf")
    return close.join(docs, "leaf").select("leaf", "line")
