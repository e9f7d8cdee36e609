"""Documents to training tokens: quality, exact and near dedup, mixing, tokens.

Every stage takes all its predecessor kept, whole texts included; between stages the documents are
written as Parquet and read again, so a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.llm import bpe, exact_dedup, jaccard, mixing, quality
from examloom.llm.common import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host is not rejected."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside."""
    return exact_dedup.keep_first(docs, exact_dedup.new_index(spark))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of common five-word shingles."""
    return jaccard.keep_one(docs, jaccard.Threshold(percent=80, k=5))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights; one row per epoch in which a document is selected."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether the ids decode to the very text."""
    import public_tokenizers

    return bpe.training_rows(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard", near_copies),
    ("mix_sources", mix),
    ("byte_bpe", tokens),
]

ORACLE_SQL = None  # near copies and merges are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
