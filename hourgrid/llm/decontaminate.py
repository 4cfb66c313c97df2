"""Benchmark decontamination by the q-gram lemma.

A pattern of m characters that occurs in a text with at most k edits shares at least
m + 1 - q - k * q of its q-grams with the region, all on diagonals (place in the text
minus place in the pattern) within a range of 2k + 1. Shared q-grams are counted in
overlapping bands of 2 * (2k + 1) diagonals, so every such range lies in one band;
bands that meet the bound are verified by a banded alignment of the pattern.

Items longer than ``window`` characters are looked for by overlapping windows of that
length, so long parts of them count too. Case and the kind of white space don't matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import U64, mix, rolling, total_bytes, travels_by_value

travels_by_value(__name__)

Q = 10
#: Edits allowed, as a share of a pattern's characters.
BUDGET = 0.08
WINDOW = 200
#: Stands between texts: half a surrogate pair, which no text can hold.
BORDER = "\ud800"
#: Bytes of benchmark text that one pass over the documents looks for; more makes more passes.
BLOCK_BYTES = 8 << 20
#: Characters handled at a time.
PIECE = 1 << 18


class Index(NamedTuple):
    """Patterns (text, item number, edits k, bound) and their q-grams, sorted."""

    patterns: list[tuple[str, int, int, int]]
    items: list
    grams: np.ndarray
    pattern: np.ndarray
    place: np.ndarray
    q: int


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return mix(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(U64) + U64(1))


def allowed(m: int, q: int, budget: float) -> int:
    """Edits for m characters: the budget, as far as the bound stays positive."""
    return max(0, min(int(budget * m), (m - q) // q))


def build_index(items: list[tuple[object, str | None]], q: int = Q, budget: float = BUDGET, window: int = WINDOW) -> Index:
    patterns, names = {}, []
    for name, text in items:
        text = normal(text)
        if len(text) < q:  # it has no q-gram
            continue
        names.append(name)
        starts = [0] if len(text) <= window else [*range(0, len(text) - window, window // 2), len(text) - window]
        for s in starts:
            part = text[s:s + window]
            k = allowed(len(part), q, budget)
            patterns[part, len(names) - 1] = (part, len(names) - 1, k, len(part) + 1 - q - k * q)
    found = list(patterns.values())
    grams = [rolling(codes(p[0]), q) for p in found]
    flat = np.concatenate(grams) if grams else np.empty(0, U64)
    order = np.argsort(flat, kind="stable")
    pattern = np.repeat(np.arange(len(found)), [len(g) for g in grams])[order]
    place = np.concatenate([np.arange(len(g)) for g in grams])[order] if grams else np.empty(0, np.int64)
    return Index(found, names, flat[order], pattern, place, q)


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<i4")


def align(patterns: np.ndarray, texts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(edits, end) of the best occurrence of each pattern within its band of diagonals.

    ``patterns`` has a row of m characters for each pair, ``texts`` the m + width - 1
    characters that its band of ``width`` diagonals runs over. Occurrences start and end
    anywhere in the band; ``end`` counts from the start of the row of ``texts``. Pairs
    that need more than ``most`` edits get ``most + 1``; they are left as soon as that is
    certain.
    """
    n, m = patterns.shape
    width = texts.shape[1] - m + 1
    edits, ends = np.full(n, most + 1), np.zeros(n, np.int64)
    steps, left, row = np.arange(width, dtype=np.int32), np.arange(n), np.zeros((n, width), np.int32)
    for i in range(m):
        new = row + (texts[left, i:i + width] != patterns[left, i, None])
        np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        if i % 16 == 15 or i == m - 1:
            fine = row.min(axis=1) <= most
            left, row = left[fine], row[fine]
            if not len(left):
                break
    if len(left):
        best = row.argmin(axis=1)
        edits[left] = row[np.arange(len(left)), best]
        ends[left] = best + m
    return edits, ends


def bands(index: Index, text: str, bitmap: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(pattern, first, last diagonal) of the bands that share enough q-grams."""
    hashes = rolling(codes(text), index.q)
    at = np.flatnonzero(bitmap[hashes >> U64(42)])
    left = np.searchsorted(index.grams, hashes[at], "left")
    n = np.searchsorted(index.grams, hashes[at], "right") - left
    total = n.sum()
    if not total:
        return
    entry = np.repeat(left - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
    pattern = index.pattern[entry]
    stride = np.array([2 * k + 1 for _, _, k, _ in index.patterns])
    bound = np.array([b for *_, b in index.patterns])
    band = (np.repeat(at, n) - index.place[entry]) // stride[pattern]
    keys, shared = np.unique(np.concatenate([pattern << 32 | band + 2, pattern << 32 | band + 1]), return_counts=True)
    enough = shared >= bound[keys >> 32]
    for key in keys[enough].tolist():
        one, first = key >> 32, ((key & 0xFFFFFFFF) - 2) * int(stride[key >> 32])
        yield one, first, first + 2 * int(stride[one]) - 1


def regions(index: Index, text: str, bitmap: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(pattern, start, end, edits) of the verified occurrences in a normalised text.

    Pairs of equal pattern length and budget are aligned together, a bounded number at a time.
    """
    chars = points(text)
    groups: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for one, first, last in bands(index, text, bitmap):
        pattern, _, k, _ = index.patterns[one]
        from_, to = max(0, first - k), min(len(text), last + len(pattern) + k + 1)
        exact = text.find(pattern, from_, to)
        if exact >= 0:
            yield one, exact, exact + len(pattern), 0
        else:
            groups[len(pattern), k].append((one, first - k))
    for (m, k), pairs in groups.items():
        size = m + 2 * (2 * k + 1) + 2 * k - 1
        for at in range(0, len(pairs), 256):
            part = pairs[at:at + 256]
            patterns = np.stack([points(index.patterns[one][0]) for one, _ in part])
            starts = np.array([low for _, low in part])
            places = starts[:, None] + np.arange(size)
            inside = (places >= 0) & (places < len(chars))
            texts = np.where(inside, chars[np.clip(places, 0, len(chars) - 1)], -1)
            edits, ends = align(patterns, texts, k)
            fine = np.flatnonzero(edits <= k)
            if len(fine):  # the start is the end of the same alignment backwards, from the end on
                back_places = (starts + ends)[fine, None] - 1 + k - np.arange(m + 2 * k)
                inside = (back_places >= 0) & (back_places < len(chars))
                back_texts = np.where(inside, chars[np.clip(back_places, 0, len(chars) - 1)], -1)
                _, back = align(patterns[fine, ::-1], back_texts, m)
                for j, b in zip(fine.tolist(), back.tolist()):
                    end = int(starts[j] + ends[j])
                    yield part[j][0], max(0, end + k - b), min(len(text), end), int(edits[j])


def pieces(texts: list[str], overlap: int, between: str) -> Iterator[tuple[str, np.ndarray, list[tuple[int, int, int]]]]:
    """Texts of about PIECE characters joined by ``between``, with the first place and the
    (text, offset, length) of each part. A text longer than a piece is cut into overlapping parts.
    """
    def joined(parts):
        firsts = np.cumsum([0] + [len(p) + len(between) for p in parts])[:-1]
        return between.join(parts), firsts

    parts, owners, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - overlap), PIECE):
            parts.append(text[at:at + PIECE + overlap])
            owners.append((i, at, len(parts[-1])))
            size += len(parts[-1]) + len(between)
            if size >= PIECE:
                yield *joined(parts), owners
                parts, owners, size = [], [], 0
    if parts:
        yield *joined(parts), owners


def matches(index: Index, texts: list[str]) -> dict[tuple[int, int], list[int]]:
    """(text, item): start and end of its matched part, fewest edits, and how many windows match.

    Between two texts stand more characters than any pattern may have edits, of a kind that no
    text has, so that no match runs from one text into the next.
    """
    bitmap = np.zeros(1 << 22, bool)
    bitmap[index.grams >> U64(42)] = True
    overlap = 2 * max((len(p) + 2 * k for p, _, k, _ in index.patterns), default=0)
    between = BORDER * (1 + max((k for _, _, k, _ in index.patterns), default=0))
    best: dict[tuple[int, int, int], tuple[int, int, int]] = {}
    for joined, firsts, owners in pieces(texts, overlap, between):
        for one, start, end, edits in regions(index, joined, bitmap):
            # edits at a text's border may take in some of what stands between; the middle is in the text
            part = int(np.searchsorted(firsts, (start + end) // 2, "right")) - 1
            text, offset, length = owners[part]
            start, end = (min(max(x - int(firsts[part]), 0), length) + offset for x in (start, end))
            best.setdefault((text, one, start), (start, end, edits))
    out: dict[tuple[int, int], list] = defaultdict(lambda: [1 << 62, 0, 1 << 30, set()])
    for (text, one, _), (start, end, edits) in sorted(best.items()):
        row = out[text, index.patterns[one][1]]
        row[0], row[1], row[2] = min(row[0], start), max(row[1], end), min(row[2], edits)
        row[3].add(one)
    return {k: [a, b, c, len(s)] for k, (a, b, c, s) in out.items()}


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", q: int = Q, budget: float = BUDGET,
          window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, item, start, end, edits, windows): a row for every text and item that it holds.

    A text holds an item when a window of it (the whole item up to ``window`` characters)
    occurs with at most ``budget`` edits a character. ``start`` and ``end`` span all
    matches of the item in the normalised text; ``windows`` counts the windows found.

    Null, empty and blank texts hold nothing; null items and items of fewer than ``q``
    characters have no q-gram and are never found; those of fewer than 2 * ``q`` are found
    without edits only. Repeated rows are each reported; items with the same id
    are reported once per distinct text. No documents or no items give no rows.

    The benchmark is read in blocks of bounded size; every block is one pass over the
    documents, without a shuffle.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).distinct()
    kind = (f"id {rows.schema['id'].dataType.simpleString()}, item {items.schema['item'].dataType.simpleString()}, "
            "start long, end long, edits int, windows int")
    found = None
    for index in _indexes(items, q, budget, window, block_bytes):
        part = rows.mapInArrow(_finder(index), kind)
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", q: int = Q, budget: float = BUDGET, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows and columns of ``docs`` whose text holds no item, as ``leaks`` finds them; no shuffle."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).distinct()
    for index in _indexes(items, q, budget, window, block_bytes):
        docs = docs.mapInArrow(_filter(index, docs.columns.index(text_col)), docs.schema)
    return docs


def _indexes(items: DataFrame, q: int, budget: float, window: int, block_bytes: int) -> Iterator[Index]:
    """Indexes over blocks of the items, each of bounded size."""
    blocks = total_bytes(items, "text") // block_bytes + 1
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield build_index([tuple(r) for r in own.collect()], q, budget, window)


def _filter(index: Index, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = matches(index, [normal(t) for t in batch.column(text).to_pylist()]) if index.patterns else {}
            held = {t for t, _ in found}
            yield batch.filter(pa.array([i not in held for i in range(batch.num_rows)], pa.bool_()))

    return run


def _finder(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            got = matches(index, [normal(t) for t in batch.column("text").to_pylist()]) if index.patterns else {}
            keys = sorted(got)
            values = np.array([got[k] for k in keys], np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array([t for t, _ in keys], pa.int64())),
                 pa.array([index.items[i] for _, i in keys], _item_type(index)),
                 pa.array(values[:, 0]), pa.array(values[:, 1]), pa.array(values[:, 2].astype(np.int32)),
                 pa.array(values[:, 3].astype(np.int32))],
                ["id", "item", "start", "end", "edits", "windows"])

    return run


def _item_type(index: Index) -> pa.DataType:
    return pa.string() if any(isinstance(x, str) for x in index.items) else pa.int64()
