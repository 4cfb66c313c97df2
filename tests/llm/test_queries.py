"""The registered corpus queries: names, contract columns, and whole results on the smallest tables."""

import hashlib
import re
from collections import Counter

import pytest

import __spark_entry__ as entry
from hourgrid.llm import queries as corpus

SF = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op4_nearest_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op5_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_conversation_repair": {"conv_id": "bigint", **dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), "bigint"),
                                 "audit": "string", "repaired_sha256": "string"},
    "op12_prefix_trie": {**dict.fromkeys(("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), "bigint"),
                         "ends_sha256": "string"},
    "op13_main_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op7_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
}


def test_names():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(corpus.ORACLES) <= set(corpus.QUERIES)


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(spark, name):
    df = corpus.QUERIES[name](spark, SF)
    assert CONTRACT[name].items() <= dict(df.dtypes).items()


def test_kept_words_digest(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    words = {r.doc_id: (r.text or "").encode().split() for r in rows}
    seen = Counter(tuple(w[i:i + 35]) for w in words.values() for i in range(len(w) - 34))
    for r in corpus.QUERIES["op5_substring_dedup"](spark, SF).collect():
        own, gone = words[r.doc_id], set()
        for i in range(len(own) - 34):
            if seen[tuple(own[i:i + 35])] > 1:
                gone.update(range(i, i + 35))
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(own), len(gone), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("name", ["op2_decontaminate", "op3_license_scan", "op8_lm_score", "op9_pii", "op10_line_dedup"])
def test_whole_results(spark, name):
    df = corpus.QUERIES[name](spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert "doc_id" in df.columns and (df.count() == n if name != "op2_decontaminate" else df.count() >= 0)
