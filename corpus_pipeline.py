"""The corpus pipeline: each stage works on the documents that the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import decontaminate, language_id, phrase_dedup, pieces, simhash
from riskspark.llm.base import stored, table

PIECE_MODEL = "piece_bpe_32k.model"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter, or of which no language stands out, go."""
    return language_id.accepted(docs, language_id.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    return simhash.keep_first(docs, 3, 2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside 13-word windows that an earlier document has are cut out; documents stay."""
    return phrase_dedup.without_passages(docs, 13)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a 10-word window of a benchmark item go."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"), 10)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their source bytes, and the decoded text, of every document that is left."""
    return pieces.encode_documents(docs, public_tokenizers.path(PIECE_MODEL))


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontamination),
    ("sentencepiece_encoding", encoding),
]

#: Learned models and connected components have no SQL form; tests run a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
