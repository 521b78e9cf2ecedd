"""Pieces of SQL text, for expressions that repeat over many columns.

One parsed string costs one call into the JVM, however long it is.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float | None) -> str:
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    value = float(value)
    if math.isfinite(value):
        return f"({value!r}D)"
    return f"CAST({text(str(value))} AS DOUBLE)"


def plain_number(df: DataFrame, column: str) -> str:
    """The column as a double with NaN taken for missing."""
    value = f"CAST({name(column)} AS DOUBLE)"
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return f"nanvl({value}, CAST(NULL AS DOUBLE))"
    return value


def rows(entries: list[dict[str, str]]) -> str:
    """A generator of one row per entry: field names with their expressions."""
    structs = [
        "named_struct(" + ", ".join(f"{text(field)}, {value}" for field, value in entry.items()) + ")"
        for entry in entries
    ]
    return f"inline(array({', '.join(structs)}))"
