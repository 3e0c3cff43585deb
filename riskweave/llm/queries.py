"""Registered queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import bloom_lm, conversations, decontaminate, html_text, licenses, mixing, ngram_join, periodic, substrings, tokens, toxicity, vantage, warc
from riskweave.llm.common import table
from riskweave.session import scratch_path


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_groups(table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


def op4_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.with_originals(warc.read_archives(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", F.col("refers_to")).alias("refers_to"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(documents).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_vantage_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_bloom_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_texts(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.find_runs(table(spark, sf_dir, "documents"), tails=True).drop("n_words", "n_dropped")


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_source_mix, op3_license_scan, op4_benchmark_containment, op5_warc_revisits, op6_main_text, op7_token_counts,
    op8_suffix_dedup, op9_vantage_neighbours, op10_toxicity, op11_bloom_lm_scores, op12_conversation_trie, op13_periodic_runs,
)}
