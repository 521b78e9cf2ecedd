"""Banding of signatures, and exact links between sets that share a band."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.flat import U64, mixed
from tripforge.llm.graph import components
from tripforge.session import Workspace

#: Sets are linked from this similarity on, in percent.
PERCENT = 75
#: Chance, at most, that a pair just similar enough shares no band.
MISS = 1e-6


def bands_needed(rows: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """Bands of ``rows`` registers each that keep the chance of a miss below ``miss``."""
    return int(np.ceil(np.log(miss) / np.log(1 - (percent / 100) ** rows)))


def band_keys(registers: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key per set and band; the band's number is part of it."""
    sets, size = registers.shape
    grouped = registers.reshape(sets, size // rows, rows)
    keys = np.broadcast_to(mixed(np.arange(size // rows, dtype=U64)), grouped.shape[:2]).copy()
    for row in range(rows):
        keys = mixed(keys ^ grouped[:, :, row])
    return keys.view(np.int64)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``shared``, ``size_a`` and ``size_b``, from the full sets of both sides.

    A side's set travels once to the pairs that need it; adaptive execution
    splits the pairs of a set that has very many.
    """
    left = sets.select(F.col("item").alias("a"), F.col("values").alias("_a"))
    right = sets.select(F.col("item").alias("b"), F.col("values").alias("_b"))
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .select("a", "b", F.expr("size(array_intersect(_a, _b))").alias("shared"), F.expr("size(_a)").alias("size_a"), F.expr("size(_b)").alias("size_b"))
    )


def linked(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose intersection is at least ``percent`` of their union."""
    return pairs.where(f"100L * shared >= {percent}L * (size_a + size_b - shared)")


def sketches(registers: np.ndarray) -> pa.Array:
    """The lowest byte of every register, one binary value per set."""
    low = np.ascontiguousarray((registers & U64(0xFF)).astype(np.uint8))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(low.shape[1]), len(low), [None, pa.py_buffer(low.tobytes())]).cast(pa.binary())


def least_equal(size: int, percent: int, miss: float = MISS) -> int:
    """Registers, of ``size``, that a pair just similar enough has equal, but for a chance below ``miss``."""
    share, chance, count = percent / 100, 0.0, 0
    while True:
        chance += math.comb(size, count) * share**count * (1 - share) ** (size - count)
        if chance > miss:
            return count
        count += 1


def _alike(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) whose sketches agree in as many registers as similar sets do. Sketches are small, sets are not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("_a", "_b"))
            equal = (left == right).sum(1)
            yield batch.select(["a", "b"]).filter(pa.array(equal >= least_equal(left.shape[1], percent)))

    known = items.select("item", "sketch")
    both = pairs.join(known.selectExpr("item AS a", "sketch AS _a"), "a").join(known.selectExpr("item AS b", "sketch AS _b"), "b")
    return both.select("a", "b", "_a", "_b").mapInArrow(run, "a long, b long")


def _rare_first(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different roots that may be similar, by an exact prefix filter.

    Values are put in the order of how many members have them, rare ones first.
    Two similar sets share a value early in that order: at the first one they
    share, enough values are left on both sides. So only early values are joined,
    under that bound, and only where members of different roots have them. Of a
    value's members those of its commonest root meet the others, not each other.
    """
    values = sets.join(members, "item").select("item", "root", F.size("values").alias("size"), F.explode("values").alias("value"))
    by_root = values.groupBy("value", "root").agg(F.count("*").alias("n"))
    counts = by_root.groupBy("value").agg(F.sum("n").alias("often"), F.max_by("root", F.struct("n", "root")).alias("main"), (F.count("*") > 1).alias("mixed"))
    shared = values.join(counts.where("often > 1"), "value")
    ordered = shared.groupBy("item", "root", "size").agg(F.array_sort(F.collect_list(F.struct("often", "value", "main", "mixed"))).alias("order"))
    # Values that no other member has come first, and are only counted.
    alone = "size - size(order)"
    early = f"slice(order, 1, greatest(0, size - CAST(ceil({percent} * size / 100D) AS INT) + 1 - ({alone})))"
    entries = ordered.select("item", "root", "size", F.expr(alone).alias("alone"), F.posexplode(F.expr(early)).alias("at", "entry"))
    entries = entries.where("entry.mixed").selectExpr("entry.value AS value", "entry.main AS main", "item", "root", "size", "size - alone - at AS left")
    one = entries.where("root <> main").selectExpr("value", "item AS a", "root AS root_a", "size AS size_a", "left AS left_a")
    two = entries.selectExpr("value", "item AS b", "root AS root_b", "size AS size_b", "left AS left_b", "root <> main AS out_b")
    most = "least(left_a, left_b)"
    return (
        one.join(two, "value")
        .where(f"root_a <> root_b AND (NOT out_b OR a < b) AND 100L * {most} >= {percent}L * (size_a + size_b - {most})")
        .selectExpr("least(a, b) AS a", "greatest(a, b) AS b")
        .distinct()
    )


#: Times that the items of a bucket are compared with one of them; what is still open then meets by rare values.
ROUNDS = 2


def groups(
    items: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame],
    work: Workspace,
    percent: int = PERCENT,
    once: bool = False,
    spent: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Components of items linked by exact similarity: ``(roots, links)``.

    ``items`` has a long ``item``, its set's ``size``, its ``bands`` and its
    ``sketch`` (an item may repeat); ``sets_of(ids)`` returns (item, values) for a
    DataFrame of items, and is asked ``once`` for all items that share a bucket where
    making sets costs more than keeping them. Tables of ``work`` that are ``spent``, those under ``items``, are dropped
    once buckets and sketches are stored. ``roots`` has (node, root) for each item that isn't the
    smallest of its component, ``links`` the links that were confirmed.

    No bucket's items all meet each other. In each round a bucket has one pivot,
    which is compared with those that are in another component, and leaves the
    bucket: linear work. Buckets whose items are all in one component, or that
    one item is left of, are done. After a few rounds the items of those that are
    still open are compared where a filter by rare values can't rule them out.
    """
    entries = items.select("item", F.explode("bands").alias("band"))
    if once:  # many items: the buckets' bounds and the join with them read one shuffle
        entries = entries.repartition("band")
    shared = entries.groupBy("band").agg(F.min("item").alias("_low"), F.max("item").alias("_high")).where("_low < _high")
    buckets = work.store(entries.join(shared.select("band"), "band").distinct(), "buckets")
    known_sets = work.store(items.join(buckets.select("item").distinct(), "item", "left_semi").select("item", "sketch").dropDuplicates(["item"]), "sketches")
    work.drop(*spent)
    none = items.sparkSession.createDataFrame([], "node long, root long")
    roots, links, tried = none, None, None
    kept = work.store(sets_of(known_sets.select("item")), "sets") if once else None

    def sets_for(ids: DataFrame) -> DataFrame:
        return sets_of(ids) if kept is None else kept.join(ids.distinct(), "item", "left_semi")

    def checked(pairs: DataFrame, name: str) -> DataFrame:
        """Links among pairs not tried before, each confirmed on full sets."""
        nonlocal tried, links
        fresh = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        fresh = work.store(fresh, f"{name}-pairs")
        tried = fresh if tried is None else tried.union(fresh)
        close = work.store(_alike(fresh, known_sets, percent), f"{name}-alike")
        ids = close.select(F.col("a").alias("item")).union(close.select(F.col("b").alias("item"))).distinct()
        found = work.store(linked(confirmed(close, sets_for(ids)), percent), f"{name}-links")
        links = found if links is None else links.union(found)
        return found

    def joined(found: DataFrame, name: str) -> DataFrame:
        return components(roots.select("node", F.col("root").alias("peer")).union(found.selectExpr("a AS node", "b AS peer")), work, name)

    for turn in range(ROUNDS + 1):
        labelled = buckets.join(roots.withColumnRenamed("node", "item"), "item", "left").withColumn("root", F.coalesce("root", "item"))
        # The first pivot is the smallest item; later ones are drawn, so that one odd item can't keep a bucket open.
        rank = F.struct(F.xxhash64("item", F.lit(turn)) if turn else F.lit(0).cast("long"), "item")
        pivots = labelled.groupBy("band").agg(F.min(F.struct(rank.alias("rank"), "item", "root")).alias("least"), F.min("root").alias("_low"), F.max("root").alias("_high"))
        pivots = pivots.where("_low < _high").selectExpr("band", "least.item AS pivot", "least.root AS top")
        opened = work.store(labelled.join(pivots, "band"), f"open-{turn}")
        if opened.isEmpty():
            break
        if turn == ROUNDS:
            members = opened.select("item", "root").distinct()
            found = checked(_rare_first(members, sets_for(members.select("item")), percent), "rare")
            roots = roots if found.isEmpty() else joined(found, "roots")
            break
        pairs = opened.where("root <> top").selectExpr("least(item, pivot) AS a", "greatest(item, pivot) AS b").distinct()
        found = checked(pairs, f"round-{turn}")
        if not found.isEmpty():
            roots = joined(found, f"roots-{turn}")
        buckets = opened.where("item <> pivot").select("item", "band")
    if links is None:
        links = items.sparkSession.createDataFrame([], "a long, b long, shared int")
    return roots, links.select("a", "b", "shared")
