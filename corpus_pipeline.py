"""The corpus pipeline: documents to a deduplicated, clean, weighted training mix.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and is
written as a table in the shared folder before the next one reads it. All but the last keep
the columns of ``documents``.

Defined results: a NULL, empty or word-less text has no known language and goes at the first stage.
Rows that repeat doc_id and text get the same decision each, and count as one document where copies
are looked for; rows without an id stay unless their text decides otherwise. Ties go to the smaller
doc_id. Further columns may have any names and are kept. Empty tables give an empty result; an
empty benchmark contaminates nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbstone.llm import decontaminate, language, mix, path_join, previous_factor
from kerbstone.llm.common import documents, settle


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language go."""
    return language.accepted(docs, spark.read.parquet(f"{sf_dir}/pages.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose word shingles are 80 % alike, directly or by others, one stays."""
    return path_join.one_of_each(docs, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes and more stay where they come first and are cut out elsewhere."""
    return previous_factor.without_repeats(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document: doc_id, source, size, target, taken."""
    return mix.mix(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_free", benchmark_free),
    ("mixed", mixed),
]
ORACLE_SQL = None  # SQL expresses neither the language model nor the similarity join


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
