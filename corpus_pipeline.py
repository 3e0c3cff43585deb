"""Corpus preparation: documents to a mix of sources, each stage an operator of ``riskweave.llm``.

Every stage reads the table that its predecessor wrote. All but the last return the columns of
documents; the last says how many words of each document the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import decontaminate, mixing, ngram_join, substrings, toxicity
from riskweave.llm.common import table
from riskweave.session import staged


def toxic_documents_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_per_group(docs)


def repeated_strings_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxic_documents_out),
    ("near_duplicates", near_duplicates_out),
    ("suffix_dedup", repeated_strings_out),
    ("decontamination", benchmark_out),
    ("source_mix", sources_mixed),
]

#: The classifier and the byte strings are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
