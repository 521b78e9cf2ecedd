"""Validation of trip tables: named rules, an audit report, and the rows that pass."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripforge.functions.coerce import coerced
from tripforge.schema import (
    GPS_COLUMNS,
    NUMBER_COLUMNS,
    REQUIRED_TRIP_COLUMNS,
    TIME_COLUMNS,
    TIME_FORMATS,
)
from tripforge.session import stored


class InvalidTable(ValueError):
    """A table breaks its contract: columns are absent, or no row is left."""


def require_columns(
    df: DataFrame, columns: Sequence[str] = REQUIRED_TRIP_COLUMNS, message: str = "Missing required columns"
) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise InvalidTable(f"{message}: {', '.join(absent)}")


def _any(conditions: list[Column]) -> Column:
    return functools.reduce(operator.or_, conditions)


def _fails(condition: Column) -> Column:
    """True where the condition is false or unknown."""
    return ~F.coalesce(condition, F.lit(False))


def missing_gps() -> Column:
    return _any([F.col(c).isNull() for c in GPS_COLUMNS])


def invalid_timestamp() -> Column:
    """A missing end, or a dropoff before the pickup; equal times are valid."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return pickup.isNull() | dropoff.isNull() | F.coalesce(dropoff < pickup, F.lit(False))


def invalid_coordinate() -> Column:
    """Off the globe. A missing coordinate counts here as well as in :func:`missing_gps`."""
    limits = {"latitude": 90, "longitude": 180}
    return _any(
        [
            _fails(F.col(f"{end}_{axis}").between(-limit, limit))
            for axis, limit in limits.items()
            for end in ("pickup", "dropoff")
        ]
    )


def invalid_value() -> Column:
    return (
        _fails(F.col("passenger_count") >= 1)
        | _fails(F.col("trip_duration") >= 0)
        | _fails(F.col("vendor_id").isin(1, 2))
    )


RULES = {
    "missing_gps_rows": missing_gps,
    "invalid_timestamp_rows": invalid_timestamp,
    "invalid_coordinate_rows": invalid_coordinate,
    "invalid_value_rows": invalid_value,
}


def breaks_any_rule() -> Column:
    return _any([rule() for rule in RULES.values()])


def coerced_trips(raw: DataFrame, formats: Sequence[str] = TIME_FORMATS) -> DataFrame:
    return coerced(raw, NUMBER_COLUMNS, TIME_COLUMNS, formats)


def valid_trips(raw: DataFrame, formats: Sequence[str] = TIME_FORMATS) -> DataFrame:
    """Coerced rows that break no rule, each distinct row once.

    The rules run before the one shuffle, and the distinct step combines copies
    on the map side, so a row copied billions of times costs one row per task.
    """
    require_columns(raw)
    return coerced_trips(raw, formats).filter(~breaks_any_rule()).dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: how many rows are copies beyond the first (NULLs count as equal)."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def grouped_trips(raw: DataFrame, formats: Sequence[str] = TIME_FORMATS) -> DataFrame:
    """Distinct coerced rows with ``_rows``, the raw rows they stand for, and ``_copies``, those that repeat a raw row.

    Duplicates are counted on the raw rows and dropped after coercion, so the
    plan groups twice: raw rows to distinct raw rows, and those to distinct
    coerced rows. Both groupings combine on the map side and the input is read
    once.
    """
    require_columns(raw)
    distinct_raw = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_rows"))
    return (
        coerced_trips(distinct_raw, formats)
        .groupBy(*raw.columns)
        .agg(F.sum("_rows").alias("_rows"), F.sum(F.col("_rows") - 1).alias("_copies"))
    )


def with_status(counts: DataFrame) -> DataFrame:
    return counts.withColumn("status", F.when(F.col("output_rows") > 0, "passed").otherwise("failed"))


def report_of(grouped: DataFrame, accepted: Column | None = None) -> DataFrame:
    """One row with the counts of every rule over grouped rows; ``accepted`` rows are the output, all good ones if not given."""

    def total(amount: Column, name: str) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0)).cast("bigint").alias(name)

    def rows_where(condition: Column, name: str) -> Column:
        return total(F.when(condition, F.col("_rows")), name)

    counts = grouped.agg(
        total(F.col("_rows"), "input_rows"),
        total(F.col("_copies"), "duplicate_rows"),
        *[rows_where(rule(), name) for name, rule in RULES.items()],
        rows_where(breaks_any_rule(), "removed_rows"),
        F.count_if(~breaks_any_rule() if accepted is None else accepted).alias("output_rows"),
    )
    return with_status(counts)


def validation_report(raw: DataFrame, formats: Sequence[str] = TIME_FORMATS) -> DataFrame:
    """One row with the counts of every rule; the input is read once."""
    return report_of(grouped_trips(raw, formats))


@dataclass(frozen=True)
class CheckedTrips:
    rows: DataFrame
    report: DataFrame

    def require_rows(self) -> CheckedTrips:
        """Raise when validation left nothing."""
        if self.rows.isEmpty():
            raise InvalidTable("Validation removed every row of the table")
        return self


def check_trips(raw: DataFrame, formats: Sequence[str] = TIME_FORMATS) -> CheckedTrips:
    """Rows and report from one reading: the grouped rows are stored, and both come out of that table."""
    grouped = stored(grouped_trips(raw, formats), "checked-trips")
    return CheckedTrips(grouped.filter(~breaks_any_rule()).select(*raw.columns), report_of(grouped))
