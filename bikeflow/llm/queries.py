"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.llm import (
    bpe,
    digest_index,
    extract,
    filter_audit,
    language,
    merkle,
    mixing,
    near_dup,
    partenum,
    pii,
    substring,
    token_store,
    whitening,
)
from bikeflow.llm.common import table
from bikeflow.plans.runtime import scratch

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=4)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_edited(table(spark, sf_dir, "documents"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = f"digest_index_{uuid.uuid4().hex}"
    decided = digest_index.deduplicate_in_batches(table(spark, sf_dir, "documents"), index)
    return decided.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), scratch(spark, "token-store")
    token_store.write(docs, folder, WORD_VOCABULARY)
    found = token_store.read(token_store.keys_of(docs), folder)
    return found.select("doc_id", "start", "n_tokens", F.col("ids_crc32"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.join_components(table(spark, sf_dir, "documents"), size=4, percent=85)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), k=4)


QUERIES = {
    q.__name__: q
    for q in (
        op1_near_duplicates, op2_language, op3_repeated_passages, op4_main_text, op5_fingerprints,
        op6_mix, op7_byte_bpe, op8_personal_data, op9_exact_dedup, op10_token_store,
        op11_ngram_join, op12_filter_audit, op13_whitening,
    )
}
