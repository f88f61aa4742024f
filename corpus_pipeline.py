"""Cleaning of a document corpus in five stages; each stage's rows are written and read again as the next one's.

Good documents (quality classifier), one of each near-duplicate group (SimHash), none that holds benchmark
passages, personal data replaced, and at last the texts as token ids with their decoded form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm import bpe, common, decontaminate, pii, quality, simhash
from lexloom.llm.queries import tokenizer_path
from lexloom.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)  # the session's settings hold for the later stages as well
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_component(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without their text, with n_tokens, ids and the digest of the decoded text."""
    return bpe.encoded_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_clean),
    ("personal_data", without_personal_data),
    ("encoding", encoded),
]

#: SQL can express neither trees, nor components, nor merges by rank; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
