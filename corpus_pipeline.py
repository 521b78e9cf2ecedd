"""The corpus pipeline: quality rules, exact and near dedup, mixing, and encoding of what is left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.llm import bpe, exact, mixing, neardup, quality
from tripforge.llm.queries import documents, vocabulary
from tripforge.session import Workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the thresholds of their language and source accept.

    A null or empty text has no words and goes. Null languages and sources are groups of their own; repeated rows are
    judged alike. An empty table stays empty; other columns pass through.
    """
    rows = docs.select(F.struct("*").alias("row"), "text", "lang", "source")
    texts = Workspace(spark, "quality").store(quality.measured(rows).drop("text"), "measured")
    return quality.quality(texts).where("kept").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id; rows that repeat it are one.

    Null and empty texts are equal. A row without an id stays only where no row of its group has one. An empty table
    stays empty; other columns pass through.
    """
    groups = exact.exact_groups(exact.by_age(docs), Workspace(spark, "exact"))
    kept = groups.where("kept").select(F.col("doc_id").alias("_id"), "text_sha256").distinct()
    lowered = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", F.sha2(lowered.cast("binary"), 256).alias("_digest"))
    same = (F.col("_digest") == F.col("text_sha256")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_digest"]).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    A row without an id has a key of its own, made from its text and larger than
    ids are; it stays where no row with an id is near it. Texts without words,
    null and empty ones among them, all stay. Rows that repeat an id are one
    document. An empty table stays empty; other columns pass through.
    """
    own = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 62))
    rows = docs.select(F.struct("*").alias("row"), F.coalesce("doc_id", own).alias("doc_id"), "text")
    found = neardup.near_duplicates(rows.select("doc_id", "text"), Workspace(spark, "near"))
    kept = found.where("kept").select(F.col("doc_id").alias("_id")).distinct()
    return rows.join(kept, F.col("doc_id") == F.col("_id"), "left_semi").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for, in a global shuffle.

    Rows without a source are a source of their own; rows with one id, or none, are drawn alike. An empty table stays
    empty; other columns pass through.
    """
    return mixing.drawn_copies(docs).select("row.*")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy, with digests of the ids and of the bytes they decode to.

    A null text counts as empty and has no tokens. An empty table gives no rows; other columns are left out.
    """
    return bpe.encoded(docs, vocabulary(), keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix_sources),
    ("byte-level BPE", encode_texts),
]

#: SQL has no merges by rank, so the last stage can't be stated in it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written and read again before the next."""
    docs, work = documents(spark, sf_dir), Workspace(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        docs = work.store(stage(spark, docs, sf_dir), f"stage-{number}")
        if number:
            work.drop(f"stage-{number - 1}")
    return docs
