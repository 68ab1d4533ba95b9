"""Queries over the given tables, one per training-data operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, divergence, exact_dedup, hard_negatives, language_id, mixing, pii, rank_bpe, simhash, suffix_dedup, token_records, url_filter, winnowing
from .common import table


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.record_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_pairs(table(spark, sf_dir, "documents"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language_id.learn_profiles(language_id.training_rows(docs), "doc_id", "text", "lang")
    return language_id.identify(docs, profiles, keep=[F.col("doc_id"), language_id.held_out().alias("held_out")])


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op11_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), hard_negatives.anchored(), hard_negatives.relabelled())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_token_records": op1_token_records, "op2_bpe": op2_bpe, "op3_winnowing": op3_winnowing, "op4_simhash_dedup": op4_simhash_dedup, "op5_suffix_dedup": op5_suffix_dedup, "op6_mixing": op6_mixing, "op7_language_id": op7_language_id, "op8_url_filter": op8_url_filter, "op9_exact_dedup": op9_exact_dedup, "op10_pii": op10_pii, "op11_rank_bpe": op11_rank_bpe, "op12_source_divergence": op12_source_divergence, "op13_hard_negatives": op13_hard_negatives}


def oracle_sql() -> dict[str, str]:
    return {"op9_exact_dedup": exact_dedup.ORACLE, "op12_source_divergence": divergence.ORACLE, "op13_hard_negatives": hard_negatives.ORACLE}
