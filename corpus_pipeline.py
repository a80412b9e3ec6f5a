"""A training-corpus pipeline over ``documents``: identify the language, drop near duplicates, drop contaminated
documents, tokenise.

Each stage works on all documents its predecessor kept and is written as Parquet before the next one reads it.
``ORACLE_SQL`` is None: language ID and byte-level BPE are not expressible in SQL; ``tests/llm`` holds ``run`` against a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortmill.llm import byte_bpe, decontamination, language_id, minhash, queries
from cohortmill.llm.staging import staged


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known (9), with whatever share; only text without letters goes."""
    return language_id.keep_identified(docs, language_id.train(docs, ~queries.held_out()), least=0.0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (6): five-word shingles, similarity 0.8."""
    return minhash.without_near_duplicates(docs, size=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage (2)."""
    return decontamination.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"), mode="documents")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and a digest of the bytes they decode to (10)."""
    return byte_bpe.tokenised(docs, queries.ranks())


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("byte-level BPE", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
