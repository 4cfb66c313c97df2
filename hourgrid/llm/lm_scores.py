"""Cross-entropy difference of documents under a target and a background n-gram model.

Both are bigram models over words with one shared vocabulary (every word of the documents,
by a 64-bit hash, so none reaches the driver), the same order and the same smoothing:
P(w | v) = (c(v, w) + m * P(w)) / (c(v) + m) and P(w) = (c(w) + 1) / (n + size of the
vocabulary), which has the end of a text and one unknown word besides. The background is
counted on all documents, the target on those of the target. A document's score is its loss
per token under the target model less that under the background model: the lower, the more
like the target.

Counts grow with the corpus and stay distributed. Documents are dealt to packs; a pack
asks for the counts of the n-grams it holds, each once, the n-grams' buckets add up what
all packs hold and answer, and the pack scores its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import U64, WORD_BASE, by_bucket, hash_words, mix, text_bytes, total_bytes, travels_by_value

travels_by_value(__name__)

#: Weight of the unigram model against a context's own counts.
SMOOTHING = 8.0
PACK_BYTES = 4 << 20
BUCKET_BYTES = 12 << 20


def distinct_words(texts: DataFrame) -> int:
    """How many lower-case words the column ``text`` has; only their number reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.unique(hash_words([t.lower() for t in text_bytes(batch.column("text"))])[0])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["word"])

    return texts.select("text").mapInArrow(run, "word long").distinct().count()


class Grams:
    """64-bit codes of tokens and n-grams: a word's hash, and fixed codes for start and end."""

    start, end = U64(2), U64(3)

    def pairs(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first token, second token) of all bigrams, text after text, and the number of bigrams of each text."""
        hashes, n = hash_words([t.lower() for t in texts])
        ends = np.cumsum(n + 1)
        first, second = np.full((2, len(hashes) + len(texts)), self.start)
        second[ends - 1] = self.end
        inner = np.ones(len(first), bool)
        inner[ends - 1] = False
        second[inner] = hashes
        inner[:] = True
        inner[ends - n - 1] = False
        first[inner] = hashes
        return first, second, n + 1

    def counted(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Codes of all n-grams: bigrams, words, one code for the total, and contexts.

        A token is a context as often as it is a word (the start as often as the end), so
        contexts share the words' codes and are not counted again.
        """
        words = [mix(x ^ U64(1 << 63)) for x in (second, np.where(first == self.start, self.end, first))]
        return np.concatenate([mix(mix(first) * U64(WORD_BASE) + second), words[0], np.zeros(len(first), U64), words[1]])


def planes(values: np.ndarray) -> bytes:
    """The values' first bytes, then their second ones and so on, which compress better."""
    return values.view("u1").reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, "u1").reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def cross_entropy_difference(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                             target_id: str = "doc_id", smoothing: float = SMOOTHING,
                             pack_bytes: int = PACK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(id, n_words, target_loss, background_loss, score): every row, losses in bits per token.

    The target is the rows whose id is among ``target``'s ids; words are lower-cased
    (A-Z). Tokens are the words and the end of the text, so null, empty and blank texts
    have one token and a score too. Rows with the same id belong to the target together;
    null ids never do. Without target rows its model is uniform but for smoothing. No
    rows give no rows. Columns other than those named are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    total = total_bytes(rows, "text")
    packs, buckets = total // pack_bytes + 1, total // bucket_bytes + 1
    grams = Grams()
    words = distinct_words(rows) + 2  # that a model predicts: one unknown, words and the end, but not the start

    def dealt(key):
        return F.pmod(key, F.lit(packs))

    rows = rows.withColumn("pack", dealt(F.when(F.col("id").isNotNull(), F.xxhash64("id")).otherwise(F.xxhash64("text"))))
    wanted = target.select(F.col(target_id).cast(id_type).alias("id")).filter("id is not null").distinct().withColumn(
        "pack", dealt(F.xxhash64("id")))

    def asked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(codes by bucket, their buckets, place of every code of the texts, tokens but the start of each text)."""
        first, second, lengths = grams.pairs(texts)
        codes, place = np.unique(grams.counted(first, second), return_inverse=True)
        of = (codes % U64(buckets)).astype(np.int64)
        order = np.lexsort((codes, of))
        rank = np.empty(len(codes), np.int64)
        rank[order] = np.arange(len(codes))
        return codes[order], of[order], rank[place].reshape(4, -1), lengths

    def ask(pack: pa.Table, targets: pa.Table) -> pa.Table:
        out = {"bucket": [], "pack": [], "codes": [], "background": [], "target": []}
        if pack.num_rows:
            texts, ids = text_bytes(pack.column("text")), set(targets.column("id").to_pylist())
            codes, of, place, lengths = asked(texts)
            inside = np.repeat([i in ids for i in pack.column("id").to_pylist()], lengths)
            n = np.bincount(place[:3].ravel(), minlength=len(codes))
            t = np.bincount(place[:3, inside].ravel(), minlength=len(codes))
            for b, own in by_bucket(of):
                out["bucket"].append(b)
                out["pack"].append(pack.column("pack")[0].as_py())
                # within a bucket the codes ascend, and the rest modulo the buckets is the same
                out["codes"].append(planes(np.diff(codes[own] // U64(buckets), prepend=U64(0)).astype("<u8")))
                for name, values in (("background", n), ("target", t)):
                    out[name].append(planes(values[own].astype("<u4")))
        return pa.table(out, pa.schema([("bucket", pa.int64()), ("pack", pa.int64()), ("codes", pa.binary()),
                                        ("background", pa.binary()), ("target", pa.binary())]))

    def answer(bucket: pa.Table) -> pa.Table:
        """For every pack, the counts of its codes over all packs, in the order of its question."""
        codes = [np.cumsum(from_planes(x, "<u8"), dtype=U64) for x in bucket.column("codes").to_pylist()]
        found, place = np.unique(np.concatenate(codes), return_inverse=True)
        ends = np.cumsum([len(c) for c in codes])[:-1]
        sums = {}
        for name in ("background", "target"):
            counts = np.concatenate([from_planes(x, "<u4") for x in bucket.column(name).to_pylist()])
            whole = np.bincount(place, weights=counts, minlength=len(found))  # exact up to 2**53
            kind = "<i8" if len(found) and whole.max() >= 2 ** 32 else "<u4"
            sums[name] = [planes(x.astype(kind)) for x in np.split(whole[place], ends)]
        return pa.table({"pack": bucket.column("pack"), "bucket": bucket.column("bucket")} | sums)

    def losses(counts: np.ndarray, place: np.ndarray) -> np.ndarray:
        """-log2 of every token's probability."""
        both, word, n, context = (counts[p] for p in place)
        return -np.log2((both + smoothing * (word + 1) / (n + words)) / (context + smoothing))

    def score(pack: pa.Table, answers: pa.Table) -> pa.Table:
        texts = text_bytes(pack.column("text"))
        values = {"n_words": np.zeros(0), "target_loss": np.zeros(0), "background_loss": np.zeros(0)}
        if texts:
            codes, of, place, lengths = asked(texts)
            order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
            sizes = [own.stop - own.start for _, own in by_bucket(of)]
            starts = np.cumsum(lengths) - lengths
            values["n_words"] = lengths - 1
            for name in ("target", "background"):
                parts = [answers.column(name)[int(i)].as_py() for i in order]
                counts = np.concatenate([from_planes(x, "<u4" if len(x) == 4 * n else "<i8") for x, n in zip(parts, sizes)])
                values[f"{name}_loss"] = np.add.reduceat(losses(counts.astype(np.float64), place), starts) / lengths
        t, b = values["target_loss"], values["background_loss"]
        return pa.table({"id": pack.column("id"), "n_words": pa.array(values["n_words"].astype(np.int64)),
                         "target_loss": t, "background_loss": b, "score": t - b})

    texts = rows.groupBy("pack")
    questions = texts.cogroup(wanted.groupBy("pack")).applyInArrow(
        ask, "bucket long, pack long, codes binary, background binary, target binary")
    answers = questions.groupBy("bucket").applyInArrow(answer, "pack long, bucket long, background binary, target binary")
    return texts.cogroup(answers.groupBy("pack")).applyInArrow(
        score, f"id {id_type}, n_words long, target_loss double, background_loss double, score double")
