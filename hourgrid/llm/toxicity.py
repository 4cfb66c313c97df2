"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The features are densities of a lexicon, how near its hits stand to second-person
pronouns, and rates of capitals, punctuation and obfuscation. The lexicon (words and
their four- and five-letter stems that mark toxic texts), the trees and the calibration
are learned from a bounded sample of labelled rows (``FIT_ROWS``); scoring reads every
whole text, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.llm.common import travels_by_value
from hourgrid.session import saved

travels_by_value(__name__)

#: Labelled rows that the lexicon, the trees and the calibration are fitted on, at most.
FIT_ROWS = 20_000
#: Entries of the lexicon, at most.
LEXICON = 2_000
#: Toxic texts of the sample that a lexicon entry occurs in, at least.
LEXICON_TEXTS = 4
#: Words between a hit and a second-person pronoun that still count as near.
NEAR = 3
SECOND_PERSON = frozenset("""you your yours yourself yourselves u ur du dich dir dein deine deinen ihr euch tu te toi ton ta
tes vous votre vos usted ustedes tú ti tus vosotros""".split())
UNMASK = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None,
                        ".": None, "-": None, "_": None, "+": None, "#": None, "%": None, "&": None})
MASKED = re.compile(r"[^\W\d_][0-9@$!*._+#%&-]+[^\W\d_]")
REPEATED = re.compile(r"([^\W\d_])\1\1")
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’…¡¿–—"
FEATURES = ["lexicon_rate", "lexicon_weight_rate", "stem_rate", "hits", "kinds", "top_weight", "near_second_person",
            "second_person_rate", "capital_rate", "shout_rate", "exclaim_rate", "punctuation_rate", "masked_rate",
            "masked_hit_rate", "repeat_rate", "length"]


def terms(word: str) -> list[str]:
    """A bare lower-case word and its stems, as the lexicon has them."""
    return [word, *(word[:n] + "~" for n in (5, 4) if len(word) > n)]


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The dense features of a whole text; zeros for a text without words."""
    raw = (text or "").split()
    if not raw:
        return [0.0] * len(FEATURES)
    n = len(raw)
    counts = Counter(raw)
    hit_words, second = {}, set()
    hits = weight = stems = masked = masked_hits = shouts = repeats = 0.0
    top = 0.0
    second_n = 0
    kinds = set()
    for word, c in counts.items():
        bare = word.strip(EDGE)
        low = bare.lower()
        if low in SECOND_PERSON:
            second.add(word)
            second_n += c
        if len(bare) > 2 and bare.isupper():
            shouts += c
        if not bare.isalpha():
            if MASKED.search(bare):
                masked += c
                plain = low.translate(UNMASK)
                if plain in lexicon:
                    masked_hits += c
                    low = plain
        if REPEATED.search(low):
            repeats += c
        for k, term in enumerate(terms(low)):
            w = lexicon.get(term)
            if w is not None:
                hits += c
                weight += w * c
                stems += c * (k > 0)
                top = max(top, w)
                kinds.add(term)
                hit_words[word] = True
                break
    near = 0
    if hit_words and second:
        at = np.array([i for i, w in enumerate(raw) if w in second])
        own = np.array([i for i, w in enumerate(raw) if w in hit_words])
        near = sum(1 for i in own if np.abs(at - i).min() <= NEAR)
    length = len(text)
    letters = sum(map(str.isalpha, text)) or 1
    return [hits / n, weight / n, stems / n, math.log1p(hits), math.log1p(len(kinds)), top,
            near / hits if hits else 0.0, second_n / n, sum(map(str.isupper, text)) / letters, shouts / n,
            (text.count("!") + text.count("?")) / length,
            (length - letters - sum(map(str.isspace, text)) - sum(map(str.isdigit, text))) / length,
            masked / n, masked_hits / n, repeats / n, math.log1p(n)]


def sample_labelled(docs: DataFrame, labels: DataFrame, fit_rows: int, salt: int = 42) -> DataFrame:
    """(text, y) of at most ``fit_rows`` labelled texts, picked by a hash of their id."""
    picked = labels.groupBy("id").agg(F.max("y").alias("y")).filter("id is not null and y is not null").orderBy(
        F.xxhash64(F.lit(salt), "id"), "id").limit(fit_rows)
    # bounded by fit_rows, so the side is broadcast and the texts stay where they are
    joined = docs.join(F.broadcast(picked), "id").select("id", "text", "y")
    return joined.orderBy(F.xxhash64(F.lit(salt), "id"), "id", "text").limit(fit_rows)


def learn_lexicon(sample: DataFrame, size: int = LEXICON, texts: int = LEXICON_TEXTS) -> dict[str, float]:
    """Terms whose presence speaks for label 1, by a smoothed log-odds z-score, with their log-odds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                words = {w.strip(EDGE).lower() for w in set((text or "").split())}
                (toxic if y else clean).update({t for w in words if w for t in terms(w)})
            names = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([toxic[w] for w in names], pa.int64()),
                 pa.array([clean[w] for w in names], pa.int64())], ["term", "n1", "n0"])

    totals = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    t1, t0 = totals.get(1, 0) + 1.0, totals.get(0, 0) + 1.0
    found = sample.select("text", "y").mapInArrow(run, "term string, n1 long, n0 long").groupBy("term").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).filter(F.col("n1") >= texts)
    odds = F.log((F.col("n1") + 0.5) / (t1 - F.col("n1") + 0.5)) - F.log((F.col("n0") + 0.5) / (t0 - F.col("n0") + 0.5))
    scored = found.withColumn("w", odds).withColumn(
        "z", F.col("w") / F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5)))
    best = scored.filter("z > 4 and w > 1.5").orderBy(F.desc("z"), "term").limit(size).collect()
    return {r.term: r.w for r in best}


def with_features(rows: DataFrame, lexicon: dict[str, float], keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the array ``x`` of features of the column ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t, lexicon) for t in batch.column("text").to_pylist()], np.float64)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES))
            lists = pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1), pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists], [*keep, "x"])

    out = T.StructType([*rows.select(*keep).schema.fields, T.StructField("x", T.ArrayType(T.DoubleType()))])
    return rows.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, out)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "toxic", fit_rows: int = FIT_ROWS, folds: int = 5,
          trees: int = 30, depth: int = 3, keep: Sequence[str] = ()) -> DataFrame:
    """(id, held_out, score, predicted): every row's calibrated probability of label 1.

    The columns ``keep`` follow within the struct ``row``, whatever their names.

    Rows whose crc32 of the id as text is divisible by ``folds`` are held out: their
    labels are never read. Of the others at most ``fit_rows`` are used; a fifth of those
    calibrates the trees. Labels, ids and all columns but the text are no inputs of a score.

    Null, empty and blank texts are scored as texts without words. Rows with a null id
    are scored and not held out. Repeated rows get the same score; of several labels of
    an id the largest counts, null labels none. If the usable labels are all equal, that
    label is the score; without any the score is 0. No rows give no rows.
    """
    carried = ["row"] if keep else []
    row = [F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row")] if keep else []
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *row)
    outer = F.coalesce(F.crc32(F.col("id").cast("string")) % folds == 0, F.lit(False))
    known = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("int").alias("y"))
    sample = saved(sample_labelled(rows.select("id", "text"), known.filter(~outer), fit_rows), "toxicity-sample")
    classes = [r.y for r in sample.select("y").distinct().collect()]
    held = rows.withColumn("held_out", outer)
    if len(classes) < 2:
        constant = float(bool(classes and classes[0]))
        return held.select("id", "held_out", F.lit(constant).alias("score"), F.lit(int(constant >= 0.5)).alias("predicted"),
                           *carried)
    calibrates = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(5)) == 0
    lexicon = learn_lexicon(sample.filter(~calibrates))
    seen = with_features(sample, lexicon, ["id", "y"]).select(
        "id", F.col("y").cast("double").alias("label"), array_to_vector("x").alias("features"))
    seen = saved(seen.select("id", "label", vector_to_array("features").alias("x")), "toxicity-features").select(
        "label", array_to_vector("x").alias("features"), calibrates.alias("calibrates"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, maxBins=64, seed=42,
                          maxMemoryInMB=64).fit(seen.filter(~F.col("calibrates")).coalesce(4))
    raw = vector_to_array("probability")[1].alias("raw")
    steps = IsotonicRegression(featuresCol="raw", labelCol="label").fit(
        model.transform(seen.filter("calibrates").coalesce(4)).select(raw, "label"))
    vectors = with_features(held, lexicon, ["id", "held_out", *carried]).select("id", "held_out", *carried, array_to_vector("x").alias("features"))
    scored = steps.transform(model.transform(vectors).select("id", "held_out", *carried, raw))
    value = F.least(F.greatest(F.coalesce(F.col("prediction"), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return scored.select("id", "held_out", value.alias("score"), (value >= 0.5).cast("int").alias("predicted"), *carried)
