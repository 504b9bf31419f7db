"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tradewind.llm import (
    conversation_tree,
    jaccard,
    language_id,
    language_model,
    minhash,
    mixing,
    quality_rules,
    resampling,
    secrets,
    sentencepiece_fst,
    sql,
    suffix_dedup,
    token_counts,
    vector_search,
)
from tradewind.llm.common import table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    model = language_id.fit_language_model(table(spark, folder, "documents"))
    return language_id.identify(language_id.page_evidence(table(spark, folder, "pages")), "page_id", model)


def op3_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


def op4_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score_texts(table(spark, folder, "documents"))


def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.top_k(table(spark, folder, "embeddings"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sentencepiece_fst.encode(docs, tokenizer_path("piece_bpe_32k.model"))


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(table(spark, folder, "documents"))


def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"))


def op11_conversation_tree(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_tree.rebuilt_tree(table(spark, folder, "conversations"))


def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    scored = resampling.importance_scores(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return scored.drop("mark")


def op13_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    listed = [
        op1_near_duplicates,
        op2_language,
        op3_mix,
        op4_lm_scores,
        op5_top_k,
        op6_quality,
        op7_token_counts,
        op8_pieces,
        op9_secrets,
        op10_repeats,
        op11_conversation_tree,
        op12_resampling,
        op13_minhash,
    ]
    return {query.__name__: query for query in listed} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express a query; fitted models, token vocabularies and their pieces it cannot."""
    return {
        "op1_near_duplicates": sql.NEAR_DUPLICATES,
        "op3_mix": sql.MIX,
        "op5_top_k": sql.TOP_K,
        "op10_repeats": sql.REPEATS,
        "op11_conversation_tree": sql.CONVERSATION_TREE,
        "op12_resampling": sql.RESAMPLING,
        "op13_minhash": sql.MINHASH,
    }
