"""One query per corpus operator, each over its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripforge.llm import (
    bpe,
    counting,
    exact,
    merkle,
    mixing,
    neardup,
    paragraphs,
    quality,
    secrets,
    sharding,
    substrings,
    whitening,
    winnow,
)
from tripforge.llm.oracles import ORACLES as ORACLES
from tripforge.session import Workspace


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary() -> bpe.Vocabulary:
    return bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share three quarters of their five-word shingles."""
    found = neardup.near_duplicates(documents(spark, sf_dir), Workspace(spark, "op1"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and thresholds per language and source."""
    texts = quality.measured(documents(spark, sf_dir)).drop("text", "n_chars")
    judged = quality.quality(Workspace(spark, "op2").store(texts, "measured"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight equal shards in a tree of two regions, by document id."""
    return sharding.sharded(documents(spark, sf_dir))


def op4_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of paragraphs, removed but for the first of each component."""
    return paragraphs.removal_counts(documents(spark, sf_dir), Workspace(spark, "op4"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact groups, the later half of the id range arriving as a batch on the earlier half."""
    return exact.exact_groups(exact.by_age(documents(spark, sf_dir)), Workspace(spark, "op5"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text."""
    return bpe.encoded(documents(spark, sf_dir), vocabulary())


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every text."""
    return secrets.secret_spans(documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every text."""
    return counting.section_tokens(documents(spark, sf_dir), vocabulary())


def op9_mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, sources weighted by the root of their size, one epoch in all."""
    return mixing.mixed_copies(documents(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and sources of the copies that ``op9_mixed_documents`` makes; no text is moved."""
    return mixing.mixed_copies(documents(spark, sf_dir).select("doc_id", "source"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 100-byte strings that occur earlier in the corpus, removed."""
    return substrings.removed_substrings(documents(spark, sf_dir), Workspace(spark, "op10"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the four leading whitened components."""
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Workspace(spark, "op11"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether a tampered copy passes."""
    return merkle.manifest(documents(spark, sf_dir), Workspace(spark, "op12"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in ten-word windows of benchmark items."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return winnow.decontaminated(documents(spark, sf_dir), benchmark, Workspace(spark, "op13"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_sharding": op3_sharding,
    "op4_paragraph_dedup": op4_paragraph_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_secret_scan": op7_secret_scan,
    "op8_token_counts": op8_token_counts,
    "op9_mixed_documents": op9_mixed_documents,
    "op9_mixing": op9_mixing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_whitening": op11_whitening,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_decontamination": op13_decontamination,
}
