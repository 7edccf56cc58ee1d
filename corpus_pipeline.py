"""A training-data pipeline of five stages over ``documents``; each stage's Parquet is the next one's input.

Every stage sees to it that the session hands Python workers few bytes at a time (``common.small_batches``): stages follow
each other on the same executors, whose memory grows with the largest batch that any of them met.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidebook.llm import bpe, mixing, ngram_join, quality_model, secret_scan
from tidebook.llm.common import small_batches
from tidebook.llm.queries import VOCABULARY
from tidebook.plans.durable import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def sparing(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def own(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return own


@sparing
def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier does not reject."""
    return quality_model.keep_good(docs)


@sparing
def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id in each group linked by five-word shingles at 80 per cent."""
    return ngram_join.keep_one(docs, words=5, percent=80)


@sparing
def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind of each secret in its place; ``n_chars`` follows the text."""
    return secret_scan.redact(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@sparing
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, a row per copy taken."""
    return mixing.mixed_documents(docs)


@sparing
def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each document of the mix."""
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify_quality),
    ("ngram_jaccard_join", join_near_copies),
    ("secret_scans", hide_secrets),
    ("source_mixing", mix_sources),
    ("byte_level_bpe", encode_bytes),
]

#: SQL can't say the fitted classifier or the tokenizer; tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
