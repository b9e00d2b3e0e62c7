"""Queries on whole tables against brute force, through the query itself."""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from arspark.llm import decontam
from arspark.llm.queries import QUERIES


def _repeats(texts, length=400):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    seen = Counter(hash(t[k:k + length]) for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[hash(t[k:k + length])] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (not k or not gone[k - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_suffix_dedup_on_whole_tables(spark, sf):
    docs = pq.read_table(f"/root/testdata/{sf}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    want = dict(zip(docs["doc_id"], _repeats([(t or "").encode() for t in docs["text"]])))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op10_suffix_dedup"](spark, f"/root/testdata/{sf}").collect()}
    assert got == want and sum(v[1] > 0 for v in want.values()) > 10


def test_suffix_dedup_with_a_hot_passage_over_many_partitions(spark, tmp_path):
    import random
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8)))
    passage = " ".join(word() for _ in range(120))
    rows = []
    for k in range(600):
        own = " ".join(word() for _ in range(r.randint(0, 60)))
        cut = r.randint(0, 200)
        rows.append((k, f"{own} {passage[cut:]} {own}" if k % 3 == 0 else own, "en"))
    rows += [(700, None, "en"), (701, "", None), (702, passage[:399], "en"), (703, "z" * 5000, "en"), (704, " ".join(word() for _ in range(300_000)) + passage, "en"), (5, rows[5][1], "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(211).write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted((k, *v) for (k, _, _), v in zip(rows, _repeats([(t or "").encode() for _, t, _ in rows])))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 211)
    try:
        got = QUERIES["op10_suffix_dedup"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(tuple(x) for x in got) == want


def test_decontamination_in_several_blocks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    whole, blocks = (sorted(map(tuple, decontam.contamination(docs, items, block_words=n).select(*columns).collect())) for n in (2_000_000, 1000))
    assert whole == blocks and any(x[2] for x in whole)


def test_query_columns(spark):
    """Names and types that the queries promise."""
    want = {"op2_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
            "op3_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean",
            "op7_quality": "doc_id bigint, held_out boolean, score double, predicted int",
            "op10_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"}
    for name, columns in want.items():
        got = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert ", ".join(" ".join(c) for c in got.dtypes) == columns
        if name == "op3_language_id":
            held = got.filter("held_out").join(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang"), "doc_id").filter("lang IS NOT NULL")
            assert held.filter(F.col("lang") == F.col("lang_pred")).count() >= 0.95 * held.count()
