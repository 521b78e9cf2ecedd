"""Filters whose limits come from the data: IQR fences and upper percentiles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.operators.quantiles import quantile_values
from tripforge.schema import TARGET_NAMES

IQR_MULTIPLIER = 1.5

# An area that holds the city and its surroundings.
CITY_LATITUDES = (40.0, 42.0)
CITY_LONGITUDES = (-75.0, -72.0)


@dataclass(frozen=True)
class Fence:
    column: str
    low: float | None
    high: float | None

    def apply(self, df: DataFrame) -> DataFrame:
        """Rows inside the fence, ends included; missing values are dropped.

        For whole numbers the ends are rounded inwards, so that the column is
        compared as it is stored and the scan can skip row groups.
        """
        low, high = self.low, self.high
        if low is None:
            return df.filter(F.lit(False))
        if isinstance(df.schema[self.column].dataType, T.IntegralType) and max(abs(low), abs(high)) < 2**53:
            low, high = math.ceil(low), math.floor(high)
        return df.filter(F.col(self.column).between(F.lit(low), F.lit(high)))


def iqr_fence(df: DataFrame, column: str, multiplier: float = IQR_MULTIPLIER) -> Fence:
    low, high = quantile_values(df, [column], [0.25, 0.75])[column]
    if low is None:
        return Fence(column, None, None)
    reach = multiplier * (high - low)
    return Fence(column, low - reach, high + reach)


def within_iqr(df: DataFrame, column: str, multiplier: float = IQR_MULTIPLIER) -> DataFrame:
    """Rows inside the column's IQR fence; unchanged where there is no such column."""
    if column not in df.columns:
        return df
    return iqr_fence(df, column, multiplier).apply(df)


def iqr_fences(df: DataFrame, columns: Sequence[str], multiplier: float = IQR_MULTIPLIER) -> list[Fence]:
    """One fence per present column, each taken from the rows that the earlier ones keep.

    Each step scans ``df`` under plain comparisons with numbers, which a Parquet
    scan takes over, so give it a stored table where its rows are costly to make.
    """
    fences: list[Fence] = []
    for column in columns:
        if column in df.columns:
            fence = iqr_fence(df, column, multiplier)
            fences.append(fence)
            df = fence.apply(df)
    return fences


def fenced(df: DataFrame, fences: Sequence[Fence]) -> DataFrame:
    for fence in fences:
        df = fence.apply(df)
    return df


def fence_report(df: DataFrame, fences: Sequence[Fence]) -> DataFrame:
    """Rows that each fence in turn removes, with its bounds; one pass over ``df``."""
    kept = [F.lit(True)]
    for fence in fences:
        inside = F.coalesce(F.col(fence.column).between(F.lit(fence.low), F.lit(fence.high)), F.lit(False))
        kept.append(kept[-1] & inside)
    counts = df.agg(*[F.count_if(k).alias(f"k{i}") for i, k in enumerate(kept)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("step"),
            F.lit(fence.column).alias("column"),
            (F.col(f"k{i}") - F.col(f"k{i + 1}")).alias("removed_rows"),
            F.lit(fence.low).cast("double").alias("lower_bound"),
            F.lit(fence.high).cast("double").alias("upper_bound"),
        )
        for i, fence in enumerate(fences)
    ]
    return counts.select(F.inline(F.array(*rows)))


def within_upper_percentile(df: DataFrame, columns: Sequence[str], prob: float = 0.99) -> DataFrame:
    """Rows at or below the percentile of every column; all limits are of the unfiltered rows."""
    limits = quantile_values(df, columns, [prob])
    for column, (limit,) in limits.items():
        df = df.filter(F.col(column) <= F.lit(limit))
    return df


def in_city(df: DataFrame) -> DataFrame:
    for end in ("pickup", "dropoff"):
        df = df.filter(F.col(f"{end}_latitude").between(*CITY_LATITUDES))
        df = df.filter(F.col(f"{end}_longitude").between(*CITY_LONGITUDES))
    return df


def target_column(df: DataFrame, names: Sequence[str] = TARGET_NAMES) -> str | None:
    """The first of the known target names that the table has."""
    return next((n for n in names if n in df.columns), None)


def finite_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every listed column holds a finite number.

    The one comparison also rejects NULL, and NaN, which sorts above infinity.
    """
    for column in columns:
        df = df.filter(F.abs(column) < float("inf"))
    return df
