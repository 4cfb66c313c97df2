"""Shared pieces: words, hashes of words and windows, packs of documents."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64
# Odd multipliers, both 5 modulo 8, of the polynomial hashes over bytes and over words
BYTE_BASE = 0x9E3779B97F4A7C15 & ~7 | 5
WORD_BASE = 0xD1B54A32D192ED03 & ~7 | 5
MASK = (1 << 64) - 1


def travels_by_value(module: str) -> None:
    """Send a module's worker functions by value: executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


travels_by_value(__name__)


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def total_bytes(rows: DataFrame, column: str) -> int:
    return int(rows.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0)


def with_packs(rows: DataFrame, key: list[str], packs: int) -> DataFrame:
    """Deal rows to ``packs`` packs by a hash of ``key``, as column ``pack``.

    With a number that grows with the input, grouping by it makes groups of bounded size
    that hold whole rows.
    """
    return rows.withColumn("pack", F.pmod(F.xxhash64(*key), F.lit(packs)))


# ---- rows, inside tasks ----------------------------------------------------


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, one after the other."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def batches_of(rows: Iterable[tuple], fields: list[tuple[str, pa.DataType]], size: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` of the rows, which are read as they are needed."""
    rows, schema = iter(rows), pa.schema(fields)
    while found := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)


# ---- numpy, inside tasks ---------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n."""
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, U64)
        if n:
            p[0] = 1
        both.append(np.cumprod(p, dtype=U64))
    return both[0], both[1]


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive values."""
    if len(values) < width:
        return np.empty(0, U64)
    up, down = powers(WORD_BASE, len(values) + 1)
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(values * up[:-1], dtype=U64)])
    n = len(values) - width + 1
    return mix((sums[width:] - sums[:n]) * down[:n])


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 of every text; empty for null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def hash_words(texts: list[bytes], chunk: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, in order, and the number of words of each text.

    Bytes are handled about ``chunk`` at a time, cut between texts or between words, so
    the byte-sized arrays stay small even for one very long text.
    """
    table = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
    up, down = powers(BYTE_BASE, 2 * chunk)
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)

    def take(parts: list[bytes], owners: list[int]) -> None:
        nonlocal up, down
        joined = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", np.uint8)
        if len(joined) > len(up):  # one very long word
            up, down = powers(BYTE_BASE, len(joined))
        space = (joined == 32) | ((joined >= 9) & (joined <= 13))
        starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(table[joined] * up[:len(joined)], dtype=U64)])
        hashes.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64)))
        begins = np.cumsum([1] + [len(p) + 1 for p in parts[:-1]])
        per = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
        np.add.at(counts, owners, per)

    parts, owners, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            piece = text[at:at + chunk]
            if at + chunk < len(text):  # cut after the last space, or take a word longer than a chunk whole
                cut = max(piece.rfind(bytes([c])) for c in (32, 9, 10, 11, 12, 13))
                if cut < 0:
                    found = [k for k in (text.find(bytes([c]), at) for c in (32, 9, 10, 11, 12, 13)) if k >= 0]
                    piece = text[at:min(found, default=len(text) - 1) + 1]
                else:
                    piece = piece[:cut + 1]
            at += len(piece)
            parts.append(piece)
            owners.append(i)
            size += len(piece)
            if size >= chunk:
                take(parts, owners)
                parts, owners, size = [], [], 0
    if parts:
        take(parts, owners)
    return (np.concatenate(hashes) if hashes else np.empty(0, U64)), counts


def by_bucket(buckets: np.ndarray) -> list[tuple[int, slice]]:
    """The buckets of a sorted array of bucket numbers, each with its slice; as many steps as there are buckets in it."""
    if not len(buckets):
        return []
    starts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    ends = np.append(starts[1:], len(buckets))
    return [(b, slice(*at)) for b, *at in zip(buckets[starts].tolist(), starts.tolist(), ends.tolist())]
