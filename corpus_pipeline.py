"""The corpus pipeline: language ID, exact dedup, near dedup, mixing, BPE. Each stage works on what the one before kept.

All stages but the last return the columns of ``documents``. Null and odd rows have the results that each
operator states: a null or letterless text is rejected by the first stage, so later stages see none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyrelith.llm import bpe, exact_dedup, language_id, mixing, near_dedup
from pyrelith.runtime import Scratch


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; rejected are those without a letter and those that no learned language fits."""
    return language_id.keep_identified(docs)


def one_of_each_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id."""
    return exact_dedup.drop_exact_copies(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 80 % of their five-word shingles the one with the smallest id."""
    return near_dedup.drop_near_copies(docs, percent=80)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's target takes them, the one at each cut with its first words."""
    return mixing.mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of every row's ids and of what they decode to."""
    import public_tokenizers

    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", known_language),
    ("exact dedup", one_of_each_text),
    ("near dedup", one_of_near_copies),
    ("mixing", mixed_sources),
    ("BPE", token_ids),
]

#: SQL has neither the language model nor the near copies; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
