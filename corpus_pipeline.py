"""A training corpus from `documents`: five operators, each on all that the one before it kept.

Null texts have no language and go at the first stage; empty tables pass through
empty; columns beyond those of `documents` are carried along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import bpe, decontam, jaccardjoin, langid, secretscan
from changeloom.llm.frames import ship, store
from changeloom.llm.queries import VOCABULARY


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    ship(spark)
    return langid.keep(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, the one with the least id."""
    ship(spark)
    return jaccardjoin.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    ship(spark)
    return decontam.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    clean = secretscan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every document."""
    ship(spark)
    return bpe.round_trip(docs, VOCABULARY, ids=True)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("secret_free", secret_free),
    ("token_ids", token_ids),
]

# Classifier, Bayesian pruning and BPE have no SQL form; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
