"""From raw documents to packed training windows: every stage works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certrisk.llm.line_dedup import dedup_units
from certrisk.llm.packing import pack
from certrisk.llm.pii import redacted
from certrisk.llm.quality_rules import kept_documents
from certrisk.llm.set_join import one_of_each
from certrisk.session import staged


def with_length(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with ``n_chars`` counting the changed text."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8), the one with the smallest id."""
    return one_of_each(docs, width=5, percent=80)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines and the passages of fifty words that an earlier one has."""
    return with_length(dedup_units(docs, passage_words=50, cut_passages=True), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return with_length(redacted(docs), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 1024 ids: one row per piece, with its ids."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_lines),
    ("PII", personal_data),
    ("packing", packing),
]

#: Tokenising and a trained model are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
