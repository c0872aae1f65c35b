"""Registered queries of the numbered operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    byte_bpe,
    conversations,
    fingerprint,
    html_text,
    language,
    oracle,
    packing,
    pii,
    resampling,
    secrets,
    sharding,
    simhash,
    suffix_dedup,
    topk,
)
from .common import table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    return packing.packed(cut, spark)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    learnt = language.in_training()
    model = language.fit(documents, learnt)
    return language.identified(documents, language.share_model(model, spark), ~learnt)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return byte_bpe.digests(documents, BYTE_RANKS, public_tokenizers.PATTERN)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"), spark)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), spark)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pii.personal_data(documents, spark.sparkContext.broadcast(pii.learned(documents)))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"), spark)


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edits(table(spark, sf_dir, "documents"), spark)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.main_text(pages, spark.sparkContext.broadcast(html_text.learned(pages)))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resampled(documents, benchmark, spark)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), spark)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.reports(conversations.damaged(table(spark, sf_dir, "conversations")), spark)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_language": op2_language,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_simhash": op4_simhash,
    "op5_topk": op5_topk,
    "op6_pii": op6_pii,
    "op7_secrets": op7_secrets,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_fingerprint": op9_fingerprint,
    "op10_html_text": op10_html_text,
    "op11_resampling": op11_resampling,
    "op12_sharding": op12_sharding,
    "op13_conversations": op13_conversations,
    "pipeline": corpus_pipeline.run,
}

#: The other operators can't be stated in SQL; tests/llm holds each one against a
#: brute-force version.
LLM_ORACLE: dict[str, str] = {
    "op11_resampling": oracle.RESAMPLE,
    "op12_sharding": oracle.SHARDS,
    "op13_conversations": oracle.CONVERSATIONS,
}
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
