"""Queries that look at one text at a time."""

import public_tokenizers

from riskspark.llm import language_id, main_text, pieces
from riskspark.llm.base import table
from riskspark.llm.registry import query

PIECE_MODEL = "piece_bpe_32k.model"


@query("op4_sentencepiece")
def sentencepiece_digests(spark, sf_dir):
    return pieces.digests(pieces.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL)))


@query("op5_main_text")
def main_text_of_pages(spark, sf_dir):
    return main_text.extract_pages(table(spark, sf_dir, "pages"))


@query("op8_language_id")
def language_of_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs))
