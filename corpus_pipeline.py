"""The corpus pipeline: documents through stages, each a written table for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import jaccard, language, packing, quality, secrets
from ledgerlens.llm.shared import stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that no learned language claims go."""
    return language.in_a_language(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that fail the base rules or the trusted corpus' ratio go."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each group of near duplicates the document with the smallest id stays."""
    return jaccard.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: secrets are masked; all documents stay."""
    return secrets.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: what is left, as pieces in training windows. The last stage shares its
    executors with what the stages before left in workers and heap, so it holds less."""
    return packing.pack(docs, slice_bytes=2 << 20, unit_bytes=24 << 20)


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_duplicates", distinct_documents),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Trained models and tokenizers are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
