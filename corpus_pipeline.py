"""A corpus pipeline of five stages, each written as Parquet and read again by the next one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from passagework.llm import jaccard, line_dedup, packing, quality, suffix_dedup
from passagework.runtime import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept; fitted on the labelled ones not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.in_fold(F.col("doc_id")))
    model = quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return quality.accepted(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand, equal or nearly so, anywhere earlier."""
    return line_dedup.dedup_lines(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard.keep_one(docs)


def drop_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that start anywhere earlier."""
    return suffix_dedup.dedup(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, packed into sequences of 1024."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("lines", drop_repeated_lines),
    ("near-copies", keep_one_of_near_copies),
    ("passages", drop_repeated_bytes),
    ("packing", pack),
]
# Trained rules, sampled paths and local search are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
