"""Samples and splits by a hash of the row key: the same rows on every run and every cluster."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge.operators.ranking import numbered

SORTABLE = 100_000  # hashes that one task may sort
DIGITS = 4  # hex digits looked at in one pass: 65,536 counts


def row_hash(key: str | Sequence[str], seed: int) -> Column:
    keys = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def _hash_prefix(hashes: DataFrame, n: int | None, share: float | None) -> tuple[str, int] | None:
    """Leading digits of the n-th smallest hash, and its place among hashes with these digits.

    Each pass counts the hashes by four more digits, at most 65,536 counts, until
    few enough hashes share the digits. None where there are fewer than n rows.
    """
    prefix, left = "", n
    while True:
        shown = len(prefix) + DIGITS
        inside = hashes.filter(F.col("h").startswith(prefix)) if prefix else hashes
        counts = inside.groupBy(F.substring("h", 1, shown).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        if left is None:
            left = math.ceil(share * sum(row["n"] for row in counts))
        for row in sorted(counts, key=lambda r: r["p"]):
            if row["n"] >= left:
                break
            left -= row["n"]
        else:
            return None
        prefix = row["p"]
        if row["n"] <= SORTABLE or shown >= 32:
            return prefix, left


def _last_hash(hashes: DataFrame, n: int | None, share: float | None) -> tuple[str, int] | None:
    """The n-th smallest hash, and how many of the n smallest have it; None where there are fewer rows."""
    found = _hash_prefix(hashes, n, share)
    if found is None:
        return None
    prefix, place = found
    tail = hashes.filter(F.col("h").startswith(prefix)).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("h").rowsBetween(Window.unboundedPreceding, -1))
    # Hashes that share so many digits are few; copies of one hash are one row here.
    row = tail.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < place).orderBy(F.desc("h")).first()
    return row["h"], place - row["before"]


def hash_cut(
    df: DataFrame, key: str | Sequence[str], n: int | None = None, seed: int = 42, share: float | None = None
) -> str | None:
    """The largest of the ``n`` smallest row hashes; None where there are fewer rows.

    With ``share`` in place of ``n``, the number is that share of the rows, rounded up.
    """
    found = _last_hash(df.select(row_hash(key, seed).alias("h")), n, share)
    return found and found[0]


def sample_rows(df: DataFrame, key: str | Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, or all rows where there are no more than ``n``.

    The rows with the ``n`` smallest hashes: counts by leading digits find the last
    of them, and the sample is a filter, so its rows stay where they are and none
    is sorted. Of rows that share the last key, as many as fit are numbered and kept.
    """
    hashes = df.select(row_hash(key, seed).alias("h"))
    found = _last_hash(hashes, n, None)
    if found is None:
        return df
    last, wanted = found
    if hashes.filter(F.col("h") == last).count() == wanted:
        return df.filter(row_hash(key, seed) <= last)
    ties = numbered(df.filter(row_hash(key, seed) == last), name="_number").filter(F.col("_number") <= wanted)
    return df.filter(row_hash(key, seed) < last).unionByName(ties.drop("_number"))


def merged_sample(samples: Sequence[DataFrame], key: str | Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """The sample of ``n`` rows of several tables together, from a sample of at least ``n`` rows of each.

    The rows with the smallest hashes of the whole are among those of its parts,
    so parts can be sampled where and when they arrive. Seeds must agree.
    """
    return sample_rows(reduce(DataFrame.unionByName, samples), key, n, seed)


def in_test_share(key: str | Sequence[str], share: float = 0.2, seed: int = 42) -> Column:
    """True for about this share of keys; needs no other row, so no pass and no shuffle."""
    if share >= 1:
        return F.lit(True)
    bound = f"{int(share * 16**8):08x}"
    return F.substring(row_hash(key, seed), 1, 8) < bound


def split_rows(
    df: DataFrame, key: str | Sequence[str], share: float = 0.2, seed: int = 42, exact: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows. ``exact`` puts ceil(share x rows) of them in the test part.

    The key should be unique: rows with equal keys stay on one side.
    """
    if exact:
        cut = hash_cut(df, key, seed=seed, share=share)
        test = row_hash(key, seed) <= F.lit(cut or "")
    else:
        test = in_test_share(key, share, seed)
    return df.filter(~test), df.filter(test)
