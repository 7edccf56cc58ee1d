"""The queries of this subpackage, each over its whole tables, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, ctw, license_scan, mixing, ngram_join, quality_model, quality_rules, secret_scan, sharding, source_audit, topk, vector_codes
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "byte_bpe_50k.tiktoken"


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text of ``documents`` and the bytes that they decode to, as digests."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op1_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree scores of all ``documents``, learnt from those whose crc32(doc_id) mod 7 is not 2."""
    return ctw.score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` under links of three-word shingles at 90 per cent."""
    return ngram_join.label(table(spark, sf_dir, "documents"), words=3, percent=90)


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest products with every other vector, for the ``embeddings`` whose vec_id is divisible by 100."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each of the ``documents``, sources weighing 5, 2, 1, held at three times their size."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences and notices in every whole text of ``documents``."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``: the base patterns, and runs of few characters to a token."""
    return secret_scan.scan(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of all ``documents``, fitted on all of them without labels."""
    return quality_model.classify(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal ``conversations``, rendered; logged beginnings of longer ones are gone."""
    return chat.render(table(spark, sf_dir, "conversations"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of all ``documents``; the bar is set on ``labels``."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all ``embeddings``, a byte for each quarter, by codebooks of 256 entries trained for four rounds."""
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between all sources of a language over its terms, and the terms that a source has more of."""
    return source_audit.audit(table(spark, sf_dir, "documents"))


def op13_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 40 shards of nearly equal bytes, equal texts together."""
    return sharding.shard(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    own = [op1_ctw_score, op2_ngram_jaccard, op3_exact_topk, op4_mix_sources, op5_license_scan, op6_secret_scan, op7_byte_bpe, op8_quality_classifier, op9_chat_format, op10_quality_rules, op11_vector_codes, op12_source_audit, op13_minimax_shards]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_ngram_jaccard": ngram_join.ORACLE, "op3_exact_topk": topk.ORACLE, "op4_mix_sources": mixing.ORACLE, "op5_license_scan": license_scan.oracle(), "op9_chat_format": chat.ORACLE, "op11_vector_codes": vector_codes.ORACLE, "op12_source_audit": source_audit.ORACLE}
