"""The queries of the numbered operators over the test tables, with the contracts' parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import alignment, byte_bpe, embedding_dedup, minhash_dedup, mixing, oracles, pii, piece_codec, piece_counts, quality_classifier, quality_rules, spelling, toxicity, warc
from .common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), 4096)


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.filter_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op8 that need no labels, which SQL can express."""
    return quality_rules.base_counts(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op3_embedding_dedup": oracles.OP3, "op5_warc": oracles.OP5, "op6_mixing": oracles.OP6, "op7_minhash_dedup": oracles.OP7, "op8_base_counts": oracles.OP8_BASE, "op11_spelling": oracles.OP11}
