"""The corpus pipeline: quality, near duplicates, personal data, mixture, tokens.

Each stage is a function of (spark, docs, sf_dir). What it returns is written as Parquet and read
again as the next stage's docs. Models and statistics of a stage come from the documents that the
stage gets. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lakehouse_kpis.llm import bpe, mixing, pii, quality, simhash
from lakehouse_kpis.llm.queries import TARGET_WEIGHTS, tokenizer_file
from lakehouse_kpis.llm.tables import table, text_batches
from lakehouse_kpis.session import shared_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    text_batches(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id: fingerprints of
    three-word shingles, linked at two or fewer differing bits; see `simhash`."""
    text_batches(spark)
    return simhash.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    text_batches(spark)
    return pii.redacted(docs, pii.fit(docs))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken as often as their rates say; the corpus keeps its expected size."""
    text_batches(spark)
    return mixing.mixed(docs, table(spark, sf_dir, "labels"), TARGET_WEIGHTS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the tokens and of the decoded texts."""
    text_batches(spark)
    return bpe.round_trip(docs, tokenizer_file())


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixture", mix_domains),
    ("tokens", tokenize),
]

# Trained models, hashes and byte-pair merges are beyond SQL; the tests hold every stage against a
# brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    place = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
