"""From raw documents to a mixed, encoded training corpus, stage by stage.

Each stage takes what its predecessor kept, written as Parquet and read again.  SQL
can express neither the language model nor the encoding, so there is no
``ORACLE_SQL``; tests compare each stage with a plain version of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import jaccard, language_id, mixing, secrets, sentencepiece_fst
from tradewind.llm.common import table, tokenizer_path
from tradewind.sources.shared import staged

VOCABULARY = "piece_bpe_32k.model"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; ``lang`` becomes the one identified.

    A NULL or empty text tells nothing: its declared language and source decide.  Repeated rows are
    judged each, rows without a doc_id like others; no documents give none.
    """
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id.

    NULL and empty texts and rows without a doc_id all stay; of equal rows one does; no documents give none.
    """
    return jaccard.keep_one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked.

    NULL and empty texts stay as they are, repeated rows are masked each; no documents give none.
    """
    return secrets.mask_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A NULL source is one of its own.  Texts without words and rows without a doc_id are taken like others of their
    source; repeated rows each; no documents give none.
    """
    return mixing.take_mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their pieces in place of the text, decoded again: ``lossless`` says whether that gives the text back.

    NULL and empty texts have no pieces; repeated rows are encoded each; no documents give none.
    """
    return sentencepiece_fst.encode(docs, tokenizer_path(VOCABULARY))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
    ("encode", encode_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
