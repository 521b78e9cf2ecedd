"""Exact dedup: binary-fuse filters over a snapshot screen incoming digests; positives are compared byte by byte."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm import fuse
from tripforge.session import Workspace

KEYS_PER_FILTER = 4_096

_DIGESTS = "doc_id long, text_sha256 string, batch string"
_FILTER = "shard long, seed long, segment long, span long, slots binary"


def normalised(text: str | None) -> bytes:
    """What decides equality: the text's UTF-8 bytes with A-Z lower-cased, a null text counting as empty."""
    return (text or "").encode().lower()


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, SHA-256 of the normalised text, and the batch (``snapshot`` or ``incoming``) of each row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [hashlib.sha256(normalised(x.as_py())).hexdigest() for x in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string()), batch["batch"]], ["doc_id", "text_sha256", "batch"])

    return docs.select("doc_id", "text", "batch").mapInArrow(hashed, _DIGESTS)


def by_age(docs: DataFrame, parts: int = 2) -> DataFrame:
    """``docs`` with a ``batch``: ids are given in order of arrival, and the last of ``parts`` ranges is incoming."""
    ends = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = (ends.low or 0), (ends.high or 0)
    start = low + (high - low + 1) * (parts - 1) // parts
    return docs.withColumn("batch", F.when(F.col("doc_id") >= start, "incoming").otherwise("snapshot"))


def _groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the largest id and the number of rows. Tasks combine copies before the shuffle."""
    return rows.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("copies"))


def _keys(column: pa.Array) -> np.ndarray:
    return np.array([int(x[:16], 16) for x in column.to_pylist()], np.uint64)


def _shard(count: int):
    """Shard of a digest by hex digits that the filters' keys don't use."""
    return F.pmod(F.conv(F.substring("text_sha256", 17, 12), 16, 10).cast("long"), F.lit(count))


def filters(snapshot: DataFrame, shards: int) -> DataFrame:
    """A filter per shard of the snapshot's digests. Shards hold distinct, uniform digests, so they stay even."""

    def built(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        made = fuse.build(_keys(table["text_sha256"]))
        return pa.Table.from_pydict(
            {"shard": [key[0].as_py()], "seed": [made.seed], "segment": [made.segment], "span": [made.span], "slots": [made.table.tobytes()]}
        )

    return snapshot.select(_shard(shards).alias("shard"), "text_sha256").groupBy("shard").applyInArrow(built, _FILTER)


def screened(incoming: DataFrame, made: DataFrame, shards: int) -> DataFrame:
    """Digests of ``incoming`` that their shard's filter lets through."""

    def passing(digest: pa.Table, table: pa.Table) -> pa.Table:
        if not digest.num_rows or not table.num_rows:
            return digest.select(["text_sha256"]).slice(0, 0)
        row = table.to_pylist()[0]
        shard = fuse.Filter(row["seed"], row["segment"], row["span"], np.frombuffer(row["slots"], np.uint8))
        return digest.select(["text_sha256"]).filter(pa.array(shard.holds(_keys(digest["text_sha256"]))))

    left = incoming.select(_shard(shards).alias("shard"), "text_sha256").groupBy("shard")
    return left.cogroup(made.groupBy("shard")).applyInArrow(passing, "text_sha256 string")


def exact_groups(docs: DataFrame, work: Workspace, keys_per_filter: int = KEYS_PER_FILTER) -> DataFrame:
    """Groups of equal texts over a snapshot and an incoming batch.

    ``docs`` has doc_id, text and batch. Texts are equal when identical after
    lower-casing A-Z; a null text counts as empty. Returns one row per input
    row: doc_id, keep_id (the largest id of the group), group_size, kept,
    text_sha256. Rows that repeat the kept id are one document and all kept. A
    row without an id is kept only if no row of its group has an id. An empty
    table gives no rows; other columns are ignored.

    The snapshot's digests are grouped once and filtered per shard; digests of
    the incoming batch are grouped among themselves, and only those that pass
    the filters meet the snapshot's buckets. Rows of groups of two or more are
    then compared, whole text against the whole text of one row of the group.
    """
    rows = work.store(digests(docs), "digests")
    old = work.store(_groups(rows.where("batch = 'snapshot'")), "snapshot")
    new = work.store(_groups(rows.where("batch = 'incoming'")), "incoming")
    shards = max(1, math.ceil(old.count() / keys_per_filter))
    hits = screened(new, work.store(filters(old, shards), "filters"), shards)
    both = new.join(hits, "text_sha256").join(old.select("text_sha256", F.col("keep_id").alias("old_id"), F.col("copies").alias("old_copies")), "text_sha256")
    both = work.store(both, "both").select(
        "text_sha256", F.greatest("keep_id", "old_id").alias("keep_id"), (F.col("copies") + F.col("old_copies")).alias("copies")
    )
    apart = old.union(new).join(both.select("text_sha256"), "text_sha256", "left_anti")
    groups = work.store(apart.union(both), "groups")
    joined = work.store(
        rows.join(groups.withColumnRenamed("text_sha256", "_digest"), F.col("text_sha256") == F.col("_digest"))
        .select("doc_id", "keep_id", F.col("copies").alias("group_size"), "text_sha256"),
        "joined",
    )
    _compare(docs, groups, work)
    work.drop("digests", "snapshot", "incoming", "filters", "both", "groups")
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def _compare(docs: DataFrame, groups: DataFrame, work: Workspace) -> None:
    """Compare the bytes of every row of a larger group with the row that the group keeps.

    Raises if a digest ever joined two texts. The kept text travels to its
    copies; adaptive execution splits the rows of a text that has very many.
    """

    def with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normalised(x.as_py()) for x in batch["text"]]
            keys = [hashlib.sha256(x).hexdigest() for x in texts]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(keys, pa.string()), pa.array(texts, pa.binary())], ["doc_id", "text_sha256", "body"])

    def unequal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrong = 0
        for batch in batches:
            wrong += sum(a.as_py() != b.as_py() for a, b in zip(batch["body"], batch["head"], strict=True))
        yield pa.RecordBatch.from_pydict({"wrong": pa.array([wrong], pa.int64())})

    bodies = docs.select("doc_id", "text").mapInArrow(with_text, "doc_id long, text_sha256 string, body binary")
    shared = groups.where("copies > 1").select("text_sha256", "keep_id")
    members = work.store(bodies.join(shared, "text_sha256"), "members")
    heads = members.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("text_sha256", F.col("body").alias("head"))
    pairs = members.join(heads.dropDuplicates(["text_sha256"]), "text_sha256")
    found = pairs.select("body", "head").mapInArrow(unequal, "wrong long").agg(F.sum("wrong")).first()[0]
    work.drop("members")
    if found:
        raise ValueError(f"{found} rows share a SHA-256 digest with a different text")
