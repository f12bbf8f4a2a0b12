"""A training corpus from raw documents: quality, language, near-duplicates, mix, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and
read again as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from halyard.llm import copies, language, mixing, packing, quality
from halyard.llm.common import materialise, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that the weak-label classifier rejects go."""
    return quality.keep_good(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents in no recognisable language, or clearly not in the one they declare, go."""
    return language.keep_identified(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of exact and near copies stays."""
    return copies.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents are repeated or left out towards the sources' target weights."""
    return mixing.emit(mixing.mix(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: pieces of the documents in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: A trained classifier and a tokenizer aren't SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, _ = materialise(docs, f"stage{k}")
    return docs
