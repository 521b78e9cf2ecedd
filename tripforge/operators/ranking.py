"""Rows with the largest values, and gapless numbers without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge.session import Workspace

GROUPS_PER_ROW = 4
PRUNE_FROM = 500


def top_rows(df: DataFrame, column: str, n: int, key: str, prune: bool | None = None) -> DataFrame:
    """The ``n`` rows with the largest ``column``; equal values in the order of ``key``.

    Every task would send its own ``n`` best rows to the last one. For a long list
    a first pass finds a floor: the n-th largest of the maxima of 4n groups of
    rows, at or above which at least ``n`` rows lie. Only those are sent on.
    """
    if n >= PRUNE_FROM if prune is None else prune:
        group = F.pmod(F.xxhash64(key), F.lit(GROUPS_PER_ROW * n))
        best = df.groupBy(group.alias("g")).agg(F.max(column).alias("m")).filter(F.col("m").isNotNull())
        floor = best.orderBy(F.desc("m")).limit(n).agg(F.min("m").alias("m"), F.count(F.lit(1)).alias("n")).first()
        if floor["n"] == n:
            df = df.filter(F.col(column) >= F.lit(floor["m"]))
    return df.orderBy(F.desc(column), key).limit(n)


def numbered(
    df: DataFrame, order: Sequence[str | Column] = (), within: Sequence[str] = (), name: str = "number", first: int = 1
) -> DataFrame:
    """``df`` with the numbers ``first``, ``first`` + 1, … in the given order, anew for each value of ``within``.

    Two passes in place of a window over all rows: rows are sorted over ranges and
    stored, every stored partition counts its rows, and what lies before it is
    added. The offsets are one small row per partition and group. Without an
    ``order`` rows are numbered as they lie. Rows are told apart by ``order``:
    rows that agree in all of it lie in one partition.
    """
    work = Workspace(df.sparkSession, "numbers")
    if order:
        keys = [*[F.col(w).asc_nulls_first() for w in within], *order]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = work.store(df.withColumn("_place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_place", 33)  # the upper bits of the running id are the partition
    groups = [F.col(w).alias(f"_in_{i}") for i, w in enumerate(within)]
    counts = placed.groupBy(part.alias("_part"), *groups).agg(F.min("_place").alias("_start"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(F.lit(0), *[f"_in_{i}" for i in range(len(within))]).orderBy("_part")
    before = F.coalesce(F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = work.store(counts.withColumn("_shift", before - F.col("_start") + first).drop("_start", "_n"), "offsets")
    same = [part == F.col("_part"), *[F.col(w).eqNullSafe(F.col(f"_in_{i}")) for i, w in enumerate(within)]]
    columns = [c for c in placed.columns if c != "_place"]
    number = (F.col("_place") + F.col("_shift")).alias(name)
    return placed.join(offsets, reduce(lambda a, b: a & b, same)).select(*columns, number)
