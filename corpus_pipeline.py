"""From documents to token ids: the stages of a training-data pipeline.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns the
documents that it keeps, with the columns of `documents`; the last one returns their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnlake.llm import bpe, decontaminate, exact_dedup, language, queries, simhash
from txnlake.llm.common import stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier tells."""
    return language.known_rows(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: most code points, then smallest id."""
    return exact_dedup.kept_rows(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each SimHash component."""
    return simhash.kept_rows(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids, and of the text they decode to, of every document."""
    return bpe.digests(queries.encoded(spark, docs))


STAGES = [
    ("language", known_language),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("tokens", tokens),
]

# Language, fingerprints and merges are beyond SQL; tests follow the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the result of each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
