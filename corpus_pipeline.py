"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last
return the columns of documents; the last returns one row per remaining row with its token digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import bpe, exact_dedup, language_id, mixing, near_copies
from strataflow.llm.common import named, stored, table, unused

#: Documents below this score, or without letters, are in none of the languages known.
MIN_SCORE = 0.02


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised."""
    profiles = language_id.learn_profiles(language_id.training_rows(docs), "doc_id", "text", "lang")
    lang, score = unused("lang_pred", "score", taken=docs.columns)
    judged = language_id.identify(docs, profiles, names=(lang, score))
    return judged.where((F.col(lang) != language_id.UNKNOWN) & (F.col(score) >= MIN_SCORE)).select(*[named(c) for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingle similarity of 0.8 or more."""
    return near_copies.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source to its target; a document taken more than once is repeated."""
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes every text; returns its token count and digests."""
    return bpe.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language ID", language), ("exact dedup", exact), ("SimHash near-dedup", near), ("mixing", mixed), ("BPE", tokens)]

#: SQL has no language profiles, fingerprints or merges; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
