"""Removal of repeated substrings of words by fixed-block anchors.

Every text is cut into non-overlapping reference blocks of ``block`` = (window + 1) // 2
words; any window of ``window`` words contains at least one whole block. The blocks are
indexed by hash, every rolling run of ``block`` words probes the index, and a run hits
when it equals an indexed block and occurs at least twice. Hits are extended to the
windows around them; windows that occur twice, by 128-bit hashes of their words, join to
the maximal exact repeats, whose words are removed.

Texts are dealt once to packs of bounded size, and all exchanges are between packs and
hash buckets: a pack names each hash once, so a passage that a third of all documents
share reaches its bucket as one value a pack, never as pairs of documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import (
    U64, by_bucket, hash_words, mix, rolling, text_bytes, total_bytes, travels_by_value, with_packs)

travels_by_value(__name__)

WINDOW = 35
PACK_BYTES = 4 << 20
#: Rolling runs that one bucket of the index receives, about.
BUCKET_RUNS = 2 << 20
LOW = U64(0xFFFFFFFF)


def _runs(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the run at each place, whether the run lies within one text)."""
    owner = np.repeat(np.arange(len(counts)), counts)
    hashes = rolling(words, width)
    inside = owner[:len(hashes)] == owner[width - 1:] if len(hashes) else np.zeros(0, bool)
    return hashes, inside


def _place(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """bucket * 2**32 + low half: sorts by bucket, and names a run within it."""
    return ((hashes >> U64(32)) % U64(buckets) << U64(32)) | (hashes & LOW)


def _packed(values: np.ndarray, kind: str) -> bytes:
    return values.astype(kind).tobytes()


def _unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, n = np.unique(values, return_counts=True)
    return found, n > 1


def repeated_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                        pack_bytes: int = PACK_BYTES, bucket_runs: int = BUCKET_RUNS) -> DataFrame:
    """(id, n_words, n_removed, kept_text): every row without its repeated words.

    A word goes when a window of ``window`` consecutive words that covers it starts
    anywhere else too, in the same text or in another row's; all copies go. Words keep
    their case; kept words are joined by one space. Windows are judged on the input.
    Null, empty and blank texts have no words and an empty kept text; texts shorter than
    a window stay whole. Repeated rows repeat each other. No rows give no rows. Ids may
    be null or repeat; columns other than the two named are not read.
    """
    block = (window + 1) // 2
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    total = total_bytes(rows, "text")
    rows = with_packs(rows, ["id", "text"], total // pack_bytes + 1)
    buckets = total // (6 * bucket_runs) + 1  # a word and its space have six bytes or more, about

    def probe(pack: pa.Table) -> pa.Table:
        words, counts = hash_words(text_bytes(pack.column("text")))
        hashes, inside = _runs(words, counts, block)
        first = np.repeat(np.cumsum(counts) - counts, counts)[:len(hashes)]
        aligned = inside & ((np.arange(len(hashes)) - first) % block == 0)
        place = _place(hashes, buckets)
        found, many = _unique(place[inside])
        blocks = np.unique(place[aligned])
        out = {"bucket": [], "pack": [], "runs": [], "many": [], "blocks": []}
        for b, own in by_bucket(found >> U64(32)):
            at = np.searchsorted(blocks, [b << 32, (b + 1) << 32])
            out["bucket"].append(b)
            out["pack"].append(pack.column("pack")[0].as_py())
            out["runs"].append(_packed(found[own] & LOW, "<u4"))
            out["many"].append(_packed(found[own][many[own]] & LOW, "<u4"))
            out["blocks"].append(_packed(blocks[at[0]:at[1]] & LOW, "<u4"))
        return pa.table(out, pa.schema([("bucket", pa.int32()), ("pack", pa.int64()), ("runs", pa.binary()),
                                        ("many", pa.binary()), ("blocks", pa.binary())]))

    def match(bucket: pa.Table) -> pa.Table:
        """The runs of each pack that equal an indexed block and occur twice."""
        parts = {c: [np.frombuffer(x, "<u4") for x in bucket.column(c).to_pylist()] for c in ("runs", "many", "blocks")}
        seen, twice = _unique(np.concatenate(parts["runs"]))
        hits = np.union1d(seen[twice], np.concatenate(parts["many"]))
        hits = np.intersect1d(hits, np.concatenate(parts["blocks"]))
        out = {"pack": [], "found": []}
        number = U64(bucket.column("bucket")[0].as_py() << 32)
        for pack, runs in zip(bucket.column("pack").to_pylist(), parts["runs"]):
            if not len(hits):
                break
            own = runs[hits[np.minimum(np.searchsorted(hits, runs), len(hits) - 1)] == runs]
            if len(own):
                out["pack"].append(pack)
                out["found"].append(_packed(own.astype(U64) | number, "<u8"))
        return pa.table(out, pa.schema([("pack", pa.int64()), ("found", pa.binary())]))

    def extend(pack: pa.Table, hits: pa.Table) -> pa.Table:
        """Windows around hits: 128-bit hashes, each once, and whether the pack has it twice."""
        out = {"bucket": [], "pack": [], "low": [], "high": [], "many": []}
        kind = pa.schema([("bucket", pa.int32()), ("pack", pa.int64()), ("low", pa.binary()), ("high", pa.binary()),
                          ("many", pa.binary())])
        if not pack.num_rows or not hits.num_rows:
            return pa.table(out, kind)
        words, counts = hash_words(text_bytes(pack.column("text")))
        hashes, inside = _runs(words, counts, block)
        named = np.sort(np.concatenate([np.frombuffer(x, "<u8") for x in hits.column("found").to_pylist()]))
        place = _place(hashes, buckets)
        hit = inside & (named[np.minimum(np.searchsorted(named, place), len(named) - 1)] == place)
        before = np.concatenate([[0], np.cumsum(hit)])
        low, inside = _runs(words, counts, window)
        reach = window - block + 1
        near = np.flatnonzero(inside & (before[reach:][:len(low)] > before[:len(low)]))
        high = rolling(mix(words ^ U64(0xA5A5A5A5A5A5A5A5)), window)[near]
        low = low[near]
        order = np.lexsort((high, low))
        low, high = low[order], high[order]
        new = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])[:len(low)]
        starts = np.flatnonzero(new)
        many = np.diff(np.append(starts, len(low))) > 1
        low, high = low[starts], high[starts]
        of = (mix(low) % U64(buckets)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        low, high, many = low[order], high[order], many[order]
        for b, own in by_bucket(of[order]):
            out["bucket"].append(b)
            out["pack"].append(pack.column("pack")[0].as_py())
            out["low"].append(_packed(low[own], "<u8"))
            out["high"].append(_packed(high[own], "<u8"))
            out["many"].append(many[own].tobytes())
        return pa.table(out, kind)

    def verify(bucket: pa.Table) -> pa.Table:
        """The windows of each pack that occur twice, by the low half of their hash."""
        packs = bucket.column("pack").to_pylist()
        parts = {c: [np.frombuffer(x, k) for x in bucket.column(c).to_pylist()]
                 for c, k in (("low", "<u8"), ("high", "<u8"), ("many", "?"))}
        low, high, many = (np.concatenate(parts[c]) for c in ("low", "high", "many"))
        owner = np.repeat(np.arange(len(packs)), [len(x) for x in parts["low"]])
        order = np.lexsort((high, low))
        same = np.zeros(len(low) + 1, bool)
        same[1:-1] = (low[order][1:] == low[order][:-1]) & (high[order][1:] == high[order][:-1])
        twice = many.copy()
        twice[order] |= same[1:] | same[:-1]
        low = low[twice]
        out = {"pack": [], "found": []}
        for k, own in by_bucket(owner[twice]):  # packs stand in order
            out["pack"].append(packs[k])
            out["found"].append(_packed(low[own], "<u8"))
        return pa.table(out, pa.schema([("pack", pa.int64()), ("found", pa.binary())]))

    def remove(pack: pa.Table, repeats: pa.Table) -> pa.Table:
        texts = text_bytes(pack.column("text"))
        gone, counts, removed = None, None, np.zeros(len(texts), np.int64)
        if len(texts) and repeats.num_rows:
            words, counts = hash_words(texts)
            low, inside = _runs(words, counts, window)
            named = np.sort(np.concatenate([np.frombuffer(x, "<u8") for x in repeats.column("found").to_pylist()]))
            hit = inside & (named[np.minimum(np.searchsorted(named, low), len(named) - 1)] == low)
            cover = np.zeros(len(words) + 1, np.int64)
            cover[:len(low)] += hit
            cover[window:window + len(low)] -= hit
            gone = np.cumsum(cover)[:len(words)] > 0
        n_words, kept, at = [], [], 0
        for i, text in enumerate(texts):
            own = text.split()
            n_words.append(len(own))
            if gone is not None:
                flags = gone[at:at + len(own)]
                at += len(own)
                removed[i] = flags.sum()
                if removed[i]:
                    own = [w for w, g in zip(own, flags.tolist()) if not g]
            kept.append(b" ".join(own))
        return pa.table({"id": pack.column("id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": removed,
                         "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})

    texts = rows.groupBy("pack")
    probes = texts.applyInArrow(probe, "bucket int, pack long, runs binary, many binary, blocks binary")
    hits = probes.groupBy("bucket").applyInArrow(match, "pack long, found binary")
    windows = texts.cogroup(hits.groupBy("pack")).applyInArrow(
        extend, "bucket int, pack long, low binary, high binary, many binary")
    repeats = windows.groupBy("bucket").applyInArrow(verify, "pack long, found binary")
    return rows.groupBy("pack").cogroup(repeats.groupBy("pack")).applyInArrow(
        remove, f"id {id_type}, n_words long, n_removed long, kept_text string")
