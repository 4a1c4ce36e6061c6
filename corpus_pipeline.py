"""From raw documents to token ids: stages, each an operator over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import bpe, mixing, nearcopies, quality, secrets
from ticketmill.llm.common import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.kept(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return nearcopies.deduplicated(spark, docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets replaced, and the length that they have then, where the table has one."""
    masked = secrets.masked(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target weights of the sources take it."""
    return mixing.repeated(spark, docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, as digests, checked by their way back."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.round_trip(spark, docs, ranks, public_tokenizers.PATTERN))


STAGES: list[tuple[str, Stage]] = [
    ("quality", drop_poor),
    ("near_copies", drop_near_copies),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
    ("bpe", encode_texts),
]

#: Quality, similarity and novelty verdicts and the token ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one keeps is written as Parquet and read by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), name)
    return docs
