"""Turn text or loosely typed columns into numbers and times; bad values become NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def number(df: DataFrame, column: str) -> Column:
    """``column`` as a number. Text that is no number, and NaN, become NULL."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        # The cast alone also takes type suffixes (1d, 5F) and hexadecimal floats, which are no numbers in a CSV file.
        value = F.when(F.col(column).rlike(_NUMBER), F.col(column).try_cast("double"))
    elif isinstance(kind, T.BooleanType):
        return F.col(column).cast("double")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.col(column).cast("double")
    elif isinstance(kind, T.NumericType):
        return F.col(column)
    else:
        return F.lit(None).cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def time(df: DataFrame, column: str, formats: Iterable[str]) -> Column:
    """``column`` as a timestamp. Text that fits none of the formats becomes NULL."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.coalesce(*[F.try_to_timestamp(F.col(column), F.lit(f)) for f in formats])
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(column).cast("timestamp")
    return F.lit(None).cast("timestamp")


def coerced(
    df: DataFrame,
    numbers: Iterable[str] = (),
    times: Iterable[str] = (),
    formats: Iterable[str] = ("yyyy-MM-dd HH:mm:ss",),
) -> DataFrame:
    """Replace the named columns by their numbers and times.

    Text is parsed once a row: a filter on top of a plain projection would be
    moved below it and parse again for each of its conditions, but it stays
    above a generator. Typed columns keep the projection, so that filters on
    them still reach the scan.
    """
    formats = list(formats)
    changed = {c: number(df, c) for c in numbers}
    changed.update({c: time(df, c, formats) for c in times})
    if any(isinstance(df.schema[c].dataType, T.StringType) for c in changed):
        row = F.struct(*[changed.get(c, F.col(c)).alias(c) for c in df.columns])
        return df.select(F.inline(F.array(row)))
    return df.withColumns(changed)


def missing(df: DataFrame, column: str) -> Column:
    """True for NULL, and for NaN in floating-point columns."""
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.col(column).isNull() | F.isnan(column)
    return F.col(column).isNull()


def finite_or_null(column: str) -> Column:
    """NULL in place of NaN and of both infinities."""
    value = F.col(column).cast("double")
    return F.when(F.abs(value) < float("inf"), value)  # NaN sorts above infinity
