"""Registered queries of the training-data operators, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, fingerprint, language, lm, mixing, mtree, packing, quality, sharding, simhash
from .common import table


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_products(table(spark, sf_dir, "embeddings"))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_query(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_query(table(spark, sf_dir, "conversations"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_packing": op2_packing,
    "op3_mtree": op3_mtree,
    "op4_lm": op4_lm,
    "op5_mixing": op5_mixing,
    "op6_sharding": op6_sharding,
    "op7_fingerprints": op7_fingerprints,
    "op8_simhash": op8_simhash,
    "op9_chat": op9_chat,
    "op10_quality": op10_quality,
}

ORACLES: dict[str, Callable[[], str]] = {
    "op3_mtree": lambda: mtree.top_products_sql(),
    "op5_mixing": mixing.mixing_sql,
    "op6_sharding": sharding.sharding_sql,
}
