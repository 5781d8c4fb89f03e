"""A corpus from raw documents to token ids: language, exact and near duplicates, source mix, byte-level BPE."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bikeflow.llm import bpe, digest_index, language, mixing, near_dup
from bikeflow.llm.common import table
from bikeflow.plans.runtime import scratch


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that the model knows go."""
    return language.keep_known(docs, language.train(docs))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays. The index of this run goes once all is decided."""
    index = f"digest_index_{uuid.uuid4().hex}"
    kept = digest_index.keep_new(docs, index, "first")
    spark.sql(f"DROP TABLE {index}")
    return kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return near_dup.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeat_copies(docs, mixing.mix(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each row's token ids and of the text that they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("language", known_language),
    ("exact duplicates", exact_duplicates),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("token ids", token_ids),
]

#: SQL can express neither the language model nor the merges of the vocabulary.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)
