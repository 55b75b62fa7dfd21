"""The corpus pipeline: quality rules, exact and near-duplicates, mixing, tokens.

Each stage takes what its predecessor kept, with the columns of ``documents``; its
decisions take effect. The last one gives the token ids of each document of the mix,
in training order by file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowsmith.llm import bpe, exact_dedup, mixing, near_dedup, quality_rules
from rowsmith.llm._io import materialize, settle, table
from rowsmith.llm.registry import tokenizer_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    settle(spark)
    return quality_rules.keep_good(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    settle(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity of 0.8 or more) the smallest doc_id."""
    settle(spark)
    return near_dedup.drop_near_duplicates(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as their source's target asks for."""
    settle(spark)
    return mixing.mixed_documents(docs)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the token ids of each document of the mix."""
    settle(spark)
    return bpe.encode_texts(docs, tokenizer_path()).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality rules", good_documents),
    ("exact dedup", distinct_documents),
    ("near dedup", dissimilar_documents),
    ("mixing", mixed_documents),
    ("bpe", encoded_documents),
]

#: Robust estimates and MinHash candidates have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; each stage's result is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
