"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm import bpe, chat, decontaminate, divergence, merkle, minhash, neighbours, pii, quality, sharding, simhash, sql, substrings, toxicity
from lexloom.plans.registry import query


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predictions(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@query("op3_simhash_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_components(_read(spark, sf_dir, "documents"))


@query("op6_benchmark_decontamination", sql.DECONTAMINATION)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


@query("op10_pii", sql.PERSONAL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_read(spark, sf_dir, "documents"))


@query("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_read(spark, sf_dir, "documents"), tokenizer_path())


@query("op4_substring_dedup", sql.SUBSTRINGS)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(_read(spark, sf_dir, "documents"))


@query("op7_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(_read(spark, sf_dir, "documents"))


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@query("op5_ann")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_read(spark, sf_dir, "embeddings"))


@query("op8_chat_formatting")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(_read(spark, sf_dir, "conversations"))


@query("op11_minhash_near_dedup", sql.SIMILAR)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.report(_read(spark, sf_dir, "documents"))


@query("op12_source_divergence", sql.DIVERGENCE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents"))


@query("op13_merkle_manifest", sql.MANIFEST)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(_read(spark, sf_dir, "documents"))
