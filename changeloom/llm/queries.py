"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import (
    bpe,
    chatformat,
    decontam,
    jaccardjoin,
    langid,
    licenses,
    pagetext,
    periodic,
    quality,
    resample,
    secretscan,
    suffixdedup,
    tokenfile,
)
from changeloom.llm.frames import ship
from changeloom.session import shared_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.report(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.report(table(spark, sf_dir, "documents"))


def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(table(spark, sf_dir, "pages"))


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-file")
    tokenfile.write(table(spark, sf_dir, "documents"), path, tokenfile.LibraryTokenizer(VOCABULARY), END_ID)
    return tokenfile.read_index(spark, path)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chatformat.format_turns(table(spark, sf_dir, "conversations"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~held_out))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccardjoin.join_texts(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"), change=periodic.planted)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_suffix_dedup,
        op3_page_text,
        op4_token_file,
        op5_decontaminate,
        op6_chat_turns,
        op7_quality_rules,
        op8_language_id,
        op9_bpe_round_trip,
        op10_jaccard_join,
        op11_resample,
        op12_periodic_runs,
        op13_license_scan,
    )
}
