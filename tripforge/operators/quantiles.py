"""Exact, interpolated quantiles of whole columns or of any number of groups.

Spark's ``percentile`` merges a map of all distinct values of a group in a single
task, so it is used only where the number of distinct values is known to be
bounded. Elsewhere the wanted ranks are closed in on: a table of brackets (group,
column, value range, ranks inside) is joined to the rows, equal cells of every
bracket are counted, and the cells that hold a rank are the next brackets. A level
costs one scan and one shuffle of counts; neither a group's values nor the
brackets come together in one place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.functions import sqltext as sql
from tripforge.session import Workspace

MAX_VALUES = 200_000  # distinct values that one task may hold
CELLS = 2_048  # parts of a bracket that are counted apart
LEAST_CELLS = 16
CELLS_IN_ALL = 1 << 22  # cells counted in one level; with many brackets each has fewer
BROADCAST_BRACKETS = 10_000  # rows of one table that the driver collects, several at a time; beyond, rows and brackets shuffle
ROWS_PER_SALT = 500_000  # rows of a group that are dealt to one task there

_INFINITY = sql.double(math.inf)


def _tall(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per present value: the group columns, ``column`` and ``value``."""
    picked = df.select(*by, *[F.expr(sql.plain_number(df, c)).alias(f"_v{i}") for i, c in enumerate(columns)])
    if len(columns) == 1:
        tall = picked.select(*by, F.lit(columns[0]).alias("column"), F.col("_v0").alias("value"))
    else:
        pairs = [{"column": sql.text(c), "value": f"_v{i}"} for i, c in enumerate(columns)]
        tall = picked.select(*by, F.expr(sql.rows(pairs)))
    return tall.filter("value IS NOT NULL")


def counted_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles over value counts: one shuffle by value, one by group."""
    return _counted(_tall(df, columns, by), probs, by)


def _counted(tall: DataFrame, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    counts = tall.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*by, "column").agg(F.percentile("value", list(probs), F.col("n")).alias("quantiles"))


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    tall = _tall(df, columns, by)
    return tall.groupBy(*by, "column").agg(F.percentile_approx("value", list(probs), accuracy).alias("quantiles"))


def _extents(df: DataFrame, columns: Sequence[str], by: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """One row per group and column: rows of the group, present values, finite range, infinities and ``measures``."""
    picked = df.select(*by, *[F.expr(sql.plain_number(df, c)).alias(f"_v{i}") for i, c in enumerate(columns)])
    aggregates, entries = ["count(*) AS _total"], []
    for i, column in enumerate(columns):
        finite = f"CASE WHEN abs(_v{i}) < {_INFINITY} THEN _v{i} END"
        found = {
            "_rows": f"count(_v{i})",
            "_low": f"min({finite})",
            "_high": f"max({finite})",
            "_below": f"count_if(_v{i} = -{_INFINITY})",
            "_above": f"count_if(_v{i} = {_INFINITY})",
            **{f"_m_{label}": f"{function}(_v{i})" for label, function in measures.items()},
        }
        aggregates += [f"{expression} AS {name}{i}" for name, expression in found.items()]
        whole = isinstance(df.schema[column].dataType, T.IntegralType)
        # An integer column has no more distinct values than its range.
        bound = f"coalesce(least(_rows{i}, _high{i} - _low{i} + 1), 0)" if whole else f"_rows{i}"
        entries.append(
            {"column": sql.text(column), "_total": "_total", **{n: f"{n}{i}" for n in found}, "_distinct": f"CAST({bound} AS DOUBLE)"}
        )
    return picked.groupBy(*by).agg(*[F.expr(a) for a in aggregates]).select(*by, F.expr(sql.rows(entries)))


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", condition: Column | None = None) -> DataFrame:
    """A join in which a null key equals a null key; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    on = reduce(lambda a, b: a & b, same if condition is None else [*same, condition])
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


@dataclass(frozen=True)
class _Search:
    """Closing in on ranks in the rows of ``df``. Brackets have by, column, low, high, before, inside, ranks and salts."""

    df: DataFrame
    columns: list[str]
    by: list[str]
    max_values: int
    cells: int
    work: Workspace

    @property
    def keys(self) -> list[str]:
        return [*self.by, "column"]

    def inside(self, brackets: DataFrame, count: int) -> DataFrame:
        """Values that lie in a bracket, with the bracket's ``low``, ``high``.

        Where rows shuffle, those of a large group are dealt to as many tasks as it has salts, each with a copy of its
        brackets. Large groups are few, as each has over ``ROWS_PER_SALT`` rows.
        """
        rows, sides = _tall(self.df, self.columns, self.by), brackets.select(*self.keys, "low", "high")
        within = F.col("value").between(F.col("low"), F.col("high"))
        if count <= BROADCAST_BRACKETS:
            return _joined(rows, F.broadcast(sides), self.keys, condition=within)
        large = brackets.filter("salts > 1").select(*self.keys, "salts").distinct()
        dealt = F.pmod(F.xxhash64("value"), F.coalesce(F.col("salts"), F.lit(1))).cast("int")
        salted = _joined(rows, F.broadcast(large), self.keys, "left").withColumn("_salt", dealt).drop("salts")
        spread = brackets.select(*self.keys, "low", "high", F.explode(F.expr("sequence(0, salts - 1)")).alias("_salt"))
        return _joined(salted, spread, [*self.keys, "_salt"], condition=within).drop("_salt")

    def narrowed(self, brackets: DataFrame, count: int) -> DataFrame:
        """The cells of brackets that hold a wanted rank, as brackets. Their ends are values that occur."""
        cells = min(self.cells, max(LEAST_CELLS, CELLS_IN_ALL // count))
        # Halves keep the width finite for any two doubles.
        share = "(value / 2 - low / 2) / (high / 2 - low / 2)"
        cell = F.expr(f"CAST(least(floor({share} * {cells}), {cells - 1}) AS INT)")
        counted = (
            self.inside(brackets, count)
            .groupBy(*self.keys, "low", cell.alias("cell"))
            .agg(F.count(F.lit(1)).alias("inside"), F.min("value").alias("least"), F.max("value").alias("most"))
        )
        known = brackets.select(*self.keys, "low", "before", "ranks", "salts")
        upto = Window.partitionBy(*self.keys, "low").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        placed = _joined(
            counted.withColumn("_earlier", F.coalesce(F.sum("inside").over(upto), F.lit(0))), known, [*self.keys, "low"]
        ).withColumn("before", F.col("before") + F.col("_earlier"))
        held = F.expr("filter(ranks, r -> r >= before AND r < before + inside)")
        ends = [F.col("least").alias("low"), F.col("most").alias("high")]
        return placed.select(*self.keys, *ends, "before", "inside", held.alias("ranks"), "salts").filter(F.size("ranks") > 0)

    def ranked(self, brackets: DataFrame, count: int) -> DataFrame:
        """Values at the wanted ranks of brackets that one task can hold."""
        counts = self.inside(brackets, count).groupBy(*self.keys, "low", "value").agg(F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy(*self.keys, "low").orderBy("value")
        placed = _joined(
            counts.withColumn("_upto", F.sum("n").over(upto)), brackets.select(*self.keys, "low", "before", "ranks"), [*self.keys, "low"]
        )
        here = F.expr("explode(filter(ranks, r -> r < before + _upto AND r >= before + _upto - n))")
        return placed.select(*self.keys, here.alias("rank"), "value")

    def values(self, brackets: DataFrame) -> DataFrame:
        """by, column, rank and value of every wanted rank."""
        found, level = [], 0
        one, small = F.col("low") == F.col("high"), F.col("inside") <= self.max_values
        while True:
            brackets = self.work.store(brackets, f"brackets-{level}")
            counts = brackets.agg(F.count_if(one), F.count_if(~one & small), F.count_if(~one & ~small)).first()
            if counts[0]:
                found.append(brackets.filter(one).select(*self.keys, F.explode("ranks").alias("rank"), F.col("low").alias("value")))
            if counts[1]:
                # Stored level by level: a plan of all levels would hold the tables of every join on the driver at once.
                found.append(self.work.store(self.ranked(brackets.filter(~one & small), counts[1]), f"ranked-{level}"))
            if not counts[2]:
                break
            brackets, level = self.narrowed(brackets.filter(~one & ~small), counts[2]), level + 1
        return reduce(DataFrame.unionByName, found) if found else brackets.select(*self.keys, F.lit(0).alias("rank"), F.col("low").alias("value"))


def _position(prob: float) -> str:
    return f"((_rows - 1) * {sql.double(prob)})"


def _by_rank(search: _Search, extents: DataFrame, probs: Sequence[float]) -> DataFrame:
    """by, column and ``quantiles`` of every row of ``extents``, which must have values."""
    ends = [f"CAST({side}({_position(p)}) AS BIGINT)" for p in probs for side in ("floor", "ceil")]
    wanted = extents.withColumn("ranks", F.expr(f"array_sort(array_distinct(array({', '.join(ends)})))"))
    finite = "r >= _below AND r < _rows - _above"
    brackets = wanted.select(
        *search.keys,
        F.col("_low").alias("low"),
        F.col("_high").alias("high"),
        F.col("_below").alias("before"),
        F.expr("_rows - _below - _above").alias("inside"),
        F.expr(f"filter(ranks, r -> {finite})").alias("ranks"),
        F.expr(f"CAST(ceil(_rows / {ROWS_PER_SALT}) AS INT)").alias("salts"),
    ).filter(F.size("ranks") > 0)
    endless = wanted.select(*search.keys, "_below", F.explode(F.expr(f"filter(ranks, r -> NOT ({finite}))")).alias("rank")).select(
        *search.keys, "rank", F.expr(f"CASE WHEN rank < _below THEN -{_INFINITY} ELSE {_INFINITY} END").alias("value")
    )
    values = search.values(brackets).unionByName(endless)
    maps = values.groupBy(*search.keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_at"))
    quantiles = []
    for p in probs:
        low, high = (f"_at[CAST({side}({_position(p)}) AS BIGINT)]" for side in ("floor", "ceil"))
        weight = f"({_position(p)} - floor({_position(p)}))"
        quantiles.append(f"CASE WHEN {low} = {high} THEN {low} ELSE (1 - {weight}) * {low} + {weight} * {high} END")
    return _joined(extents, maps, search.keys).select(*search.keys, F.expr(f"array({', '.join(quantiles)})").alias("quantiles"))


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    exact: bool = True,
    max_values: int = MAX_VALUES,
    cells: int = CELLS,
) -> DataFrame:
    """Quantiles with linear interpolation, missing values skipped.

    Returns ``by`` columns, ``column`` and ``quantiles`` (an array in the order
    of ``probs``). Columns without any value give no row. Groups may be of any
    number and size: those whose distinct values fit into a task are counted
    there, the others are solved by rank, all together.
    """
    columns, probs, by = list(columns), [float(p) for p in probs], list(by)
    if not exact:
        return approximate_quantiles(df, columns, probs, by)
    work = Workspace(df.sparkSession, "quantiles")
    extents = work.store(_extents(df, columns, by, {}), "extents")
    wide = extents.filter(F.col("_distinct") > max_values)
    count = wide.count()
    if not count:
        work.drop("extents")
        return counted_quantiles(df, columns, probs, by)
    solved = work.store(_by_rank(_Search(df, columns, by, max_values, cells, work), wide, probs), "solved")
    keys = [*by, "column"]
    if extents.filter((F.col("_distinct") <= max_values) & (F.col("_rows") > 0)).isEmpty():
        return solved
    others = wide.select(*keys)
    rest = _joined(_tall(df, columns, by), F.broadcast(others) if count <= BROADCAST_BRACKETS else others, keys, "left_anti")
    return solved.unionByName(_counted(rest, probs, by))


@dataclass(frozen=True)
class Summary:
    """A column's rows, present values, further measures and quantiles."""

    rows: int
    count: int
    measures: dict[str, float | None]
    quantiles: list[float | None]


def summaries(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    measures: dict[str, str] | None = None,
    exact: bool = True,
    max_values: int = MAX_VALUES,
    cells: int = CELLS,
) -> dict[str, Summary]:
    """Quantiles of whole columns and other aggregates of them, as Python numbers.

    The aggregates come from the pass that the quantiles need anyway, one row a column.
    """
    columns, probs, measures = list(columns), [float(p) for p in probs], measures or {}
    table = _extents(df, columns, [], measures)
    extents = table.collect()
    found = {}
    wide = [e for e in extents if e["_distinct"] > max_values] if exact else []
    if wide:
        work = Workspace(df.sparkSession, "quantiles")
        search = _Search(df, [e["column"] for e in wide], [], max_values, cells, work)
        solved = _by_rank(search, df.sparkSession.createDataFrame(wide, table.schema), probs)
        found = {row["column"]: row["quantiles"] for row in solved.collect()}
        work.close()
    narrow = [c for c in columns if c not in {e["column"] for e in wide}]
    if narrow:
        one_pass = counted_quantiles if exact else approximate_quantiles
        found |= {row["column"]: row["quantiles"] for row in one_pass(df, narrow, probs).collect()}
    nothing = [None] * len(probs)
    return {
        e["column"]: Summary(e["_total"], e["_rows"], {m: e[f"_m_{m}"] for m in measures}, found.get(e["column"], nothing)) for e in extents
    }


def quantile_values(df: DataFrame, columns: Sequence[str], probs: Sequence[float], **options) -> dict[str, list]:
    """A few quantiles per column as Python numbers, for use as limits."""
    return {c: summary.quantiles for c, summary in summaries(df, columns, probs, **options).items()}
