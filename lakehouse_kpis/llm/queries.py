"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakehouse_kpis.llm import (
    bpe, filter_audit, html_text, language, line_rules, manifest, mixing, pii, quality, shards,
    simhash, topk, vectors,
)
from lakehouse_kpis.llm.tables import table
from lakehouse_kpis.llm.twins import TWINS

# Wanted shares of the domains in the mixture's tokens.
TARGET_WEIGHTS = {"clean": 0.97, "toxic": 0.02, "low": 0.01}


def tokenizer_file() -> str:
    """The tokenizer of the encoding queries, at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pii.personal_data(documents, pii.fit(documents))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_file())


def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), TARGET_WEIGHTS
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assigned(table(spark, sf_dir, "documents"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.searched(table(spark, sf_dir, "embeddings"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.verdicts(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.proved(manifest.manifest(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_main_text, op2_personal_data, op3_bpe_round_trip, op4_vectors, op5_language,
        op6_mixture, op7_quality, op8_shards, op9_top_k, op10_simhash, op11_filter_audit,
        op12_line_rules, op13_manifest,
    )
}
ORACLE: dict[str, str] = dict(TWINS)
