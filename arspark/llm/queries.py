"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arspark.llm import chat, decontam, jaccard, langid, lm, packing, phrases, prefix_trie, quality, suffix_dedup, token_counts, vptree, warc
from arspark.llm.common import Scratch, crc_fold, table


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.coalesce(crc_fold("doc_id", 3) == 1, F.lit(False))
    model = langid.train(docs, ~fold)
    found = langid.identify(docs, model)
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score", "rejected")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = Scratch(spark, "warc").path(keep=True)
    warc.write_archives(pages, path)
    found = warc.resolved(warc.read_archives(spark, path))
    page = lambda c: F.regexp_extract(c, r"<urn:page:(.*)>", 1)
    kind = pages.schema["page_id"].dataType
    return found.select(F.when(page("record_id") != "null", page("record_id")).cast(kind).alias("page_id"), F.col("full_bytes").alias("payload_bytes"),
                        F.col("full_digest").alias("payload_digest"), F.col("type").alias("record_type"),
                        F.when(F.col("type") == "revisit", page("refers_to")).cast(kind).alias("refers_to"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)
    return found.withColumnRenamed("id", "vec_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False))
    model = quality.train(docs, labels.select("doc_id", "quality").filter(~fold))
    found = quality.score(docs, model)
    return found.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.score(docs, lm.fit(docs))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(chat.hostile_turns(spark, turns.schema["conv_id"].dataType.simpleString()))
    return chat.digests(chat.read_back(chat.format_chat(turns, chat.text_part(F.col("text")))))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.grafted(prefix_trie.sequences(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_jaccard, op2_decontamination, op3_language_id, op4_warc, op5_token_counts, op6_nearest_neighbours, op7_quality, op8_packing, op9_lm_scoring, op10_suffix_dedup,
                            op11_chat_format, op12_phrases, op13_prefix_trie)
}
ORACLE_SQL: dict[str, str] = {"op11_chat_format": chat.ORACLE, "op12_phrases": phrases.ORACLE, "op13_prefix_trie": prefix_trie.ORACLE}
