"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import bpe, chats, counts, mixing, nearcopies, phrases, quality, runs, secrets, setjoin, topk, toxicity, warc

BPE_RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.repetitions(spark, _table(spark, sf_dir, "documents"))
    words = (F.col("copies") * F.col("size")).alias("taken")
    return taken.select("doc_id", "size", "source_size", "target", words)


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(BPE_RANKS)
    return bpe.digests(bpe.round_trip(spark, _table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN))


def op3_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record; a replica with known faults, archived on its own, is audited against the archive."""
    pages = _table(spark, sf_dir, "pages")
    return warc.audit(spark, warc.archive(spark, pages), warc.archive(spark, warc.with_faults(pages)))


def op4_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.rendered(spark, _table(spark, sf_dir, "conversations"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.verdicts(spark, _table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality.FEATURES, "base_failed", "kept", "log_perplexity", "word_log_perplexity")


def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.classes(spark, _table(spark, sf_dir, "documents"))


def op7_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.scored(spark, docs, toxicity.fit_chain(spark, docs, _table(spark, sf_dir, "labels")))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(_table(spark, sf_dir, "documents")))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark, _table(spark, sf_dir, "embeddings"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(spark, _table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(spark, _table(spark, sf_dir, "documents"), rewrite=runs.planted)


def op12_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.components(spark, _table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spark, _table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = [
        op1_mix_sources, op2_bpe_round_trip, op3_warc_audit, op4_chat_snapshots, op5_quality_rules, op6_near_copies, op7_toxicity_chain,
        op8_secret_scan, op9_exact_top_k, op10_token_counts, op11_word_runs, op12_shingle_join, op13_collocations,
    ]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": mixing.ORACLE_SQL,
        "op3_warc_audit": warc.ORACLE_SQL,
        "op4_chat_snapshots": chats.ORACLE_SQL,
        "op9_exact_top_k": topk.ORACLE_SQL,
        "op12_shingle_join": setjoin.ORACLE_SQL,
        "op13_collocations": phrases.ORACLE_SQL,
    }
