"""Training-corpus pipeline: five stages over ``documents``, each on what the one before kept.

Every stage but the last returns the columns of ``documents``; its rows are
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arspark.llm import decontam, jaccard, langid, packing, suffix_dedup
from arspark.llm.common import Scratch, crc_fold, rows_with_ids, table
from arspark.llm.queries import vocabulary_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is named with enough confidence; the others go.

    A document is judged by its text alone, so rejected texts are looked up by their hash:
    the documents themselves don't pass through Python.
    """
    fold = F.coalesce(crc_fold("doc_id", 3) == 1, F.lit(False))
    model = langid.train(docs, ~fold)
    keyed = docs.withColumn("__text", F.xxhash64("text"))
    found = langid.identify(keyed, model, carry=("__text",))
    gone = Scratch(spark, "language").save(found.filter("rejected").select("__text").distinct(), keep=True)
    maybe = rows_with_ids(keyed, gone, "__text").join(gone, "__text", "left_anti").select(*keyed.columns)
    return rows_with_ids(keyed, gone, "__text", others=True).union(maybe).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id.

    Of repeated rows (same id and text) one stays; rows without an id stay; an
    id with several texts stays if any of them does.
    """
    found = jaccard.near_duplicates(docs)
    ids = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count(F.lit(1)).alias("n"))
    touched = ids.filter("NOT stays OR n > 1")
    # most rows pass without a shuffle; a bitmap of fixed size finds those that may go
    maybe = rows_with_ids(docs, touched, "doc_id").join(touched.filter("NOT stays").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    once = maybe.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]).union(maybe.filter("doc_id IS NULL"))
    return rows_with_ids(docs, touched, "doc_id", others=True).union(once)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the byte strings that repeat; bytes of characters that a cut splits go too. A null text stays null."""
    found = suffix_dedup.remove_repeats(docs, carry=tuple(docs.columns), keep="text")
    changed = F.col("text").isNotNull() & (F.col("n_removed") > 0)
    text = F.when(changed, F.col("kept")).otherwise(F.col("text"))
    out = {c: F.col(c) for c in docs.columns} | {"text": text}
    if "n_chars" in out:
        out["n_chars"] = F.when(changed, F.char_length("kept")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.select(*(v.alias(c) for c, v in out.items()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in twenty is in a benchmark window."""
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), carry=tuple(docs.columns))
    return found.filter(~F.col("contaminated")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(docs, vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language),
    ("ngram_jaccard", near_duplicates),
    ("suffix_dedup", repeats),
    ("decontamination", decontamination),
    ("best_fit_packing", packed),
]
#: No SQL expresses a trained model or sequence packing; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark, "pipeline") as scratch:
        for k, (_, stage) in enumerate(STAGES):
            before, docs = docs, scratch.save(stage(spark, docs, sf_dir), keep=k == len(STAGES) - 1)
            if k:
                scratch.drop(before)
    return docs
