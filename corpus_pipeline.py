"""A training corpus from raw documents: each stage's result is a table that the next one reads."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from syncforge.llm import bpe, decontam, jaccard, quality, suffix
from syncforge.llm.queries import pattern, tokenizer_path
from syncforge.llm.shipping import ship
from syncforge.session import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy; the others go."""
    ship(spark)
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return jaccard.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without 100-byte strings that start earlier in the corpus."""
    ship(spark)
    return suffix.cut(docs, chars="n_chars")


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark windows."""
    ship(spark)
    return decontam.cut(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), length="n_chars")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digest of the bytes they decode to."""
    ship(spark)
    lines = bpe.vocabulary(spark, tokenizer_path("byte_bpe_50k.tiktoken"))
    return bpe.encode(docs, lines, pattern(), ("n_tokens", "ids", "decoded_sha256"), also=("lang", "source", "n_chars"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("token_ids", token_ids),
]

#: SQL cannot express the token ids; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
