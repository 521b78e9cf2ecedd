"""Descriptive statistics of tables and of trips."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.functions import sqltext as sql
from tripforge.functions.calendar import rush_hour, weekday_name
from tripforge.functions.coerce import coerced, missing
from tripforge.functions.measures import minutes
from tripforge.operators.enrich import with_distance
from tripforge.operators.frequent import frequent_values
from tripforge.operators.outliers import in_city, within_upper_percentile
from tripforge.operators.quantiles import quantile_values, quantiles, summaries
from tripforge.schema import CORRELATION_COLUMNS, GPS_COLUMNS

SHORT_LIST = 1_000  # the longest list whose rank filter the engine applies within each task


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def row_and_column_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


def first_rows(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """A preview: the first ``n`` rows in an order, or any ``n`` rows; either way a task sends ``n`` rows at most."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def missing_summary(df: DataFrame) -> DataFrame:
    """Missing values per column: count, and percentage to two places."""
    columns = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]
    )
    percentage = "rint(try_divide(CAST(m{i} AS DOUBLE), _rows) * 100 * 100) / 100"
    return wide.selectExpr(
        sql.rows(
            [
                {
                    "column": sql.text(c),
                    "missing_count": f"m{i}",
                    "missing_percentage": percentage.format(i=i),
                }
                for i, c in enumerate(columns)
            ]
        )
    )


def missing_columns(df: DataFrame) -> DataFrame:
    """Columns that have missing values, the worst first."""
    return missing_summary(df).filter(F.col("missing_percentage") > 0).orderBy(F.desc("missing_percentage"), "column")


DESCRIPTION = T.StructType(
    [T.StructField("column", T.StringType()), T.StructField("count", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
)


def describe(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column."""
    columns = list(columns if columns is not None else numeric_columns(df))
    measures = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    found = summaries(df, columns, [0.25, 0.5, 0.75], measures, exact=exact)
    rows = [
        (c, s.count, s.measures["mean"], s.measures["std"], s.measures["min"], *s.quantiles, s.measures["max"])
        for c, s in found.items()
    ]
    return df.sparkSession.createDataFrame(rows, DESCRIPTION)


def value_counts(df: DataFrame, columns: Sequence[str] | None = None, top: int = 20) -> DataFrame:
    """The ``top`` most frequent values of each text column, missing ones included.

    One shuffle counts all columns together. The rank filter of a short list is
    applied before the second shuffle as well, so each task sends ``top`` rows a
    column at most; a longer list is ranked without a task that sees all values.
    """
    columns = list(columns if columns is not None else text_columns(df))
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    tall = df.select(F.inline(F.array(*pairs)))
    if top > SHORT_LIST:
        return frequent_values(tall, top)
    counts = tall.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per present value, in the order of the values."""
    present = df.filter(~missing(df, column))
    return present.groupBy(column).agg(F.count(F.lit(1)).alias("trips")).orderBy(column)


def counts_by_weekday(df: DataFrame, column: str = "pickup_weekday") -> DataFrame:
    return counts_by(df, column).withColumn("weekday_name", weekday_name(F.col(column)))


def counts_by_passengers(df: DataFrame, column: str = "passenger_count") -> DataFrame:
    return counts_by(coerced(df, [column]), column)


def missing_times(df: DataFrame, column: str = "pickup_datetime") -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("invalid_timestamps"))


def gps_summary(df: DataFrame) -> DataFrame:
    return describe(coerced(df, GPS_COLUMNS), GPS_COLUMNS)


def city_distances(df: DataFrame) -> DataFrame:
    """Trips inside the city area, with their distance."""
    return with_distance(in_city(coerced(df, GPS_COLUMNS)))


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORRELATION_COLUMNS) -> DataFrame:
    """Pearson correlations over the rows where both columns are present.

    Columns that are absent or have no value are left out; a constant column
    gives NULL. One scan: a row gives each pair of columns its two values, and the
    co-moments of a pair are built around running means and merged, within tasks
    first. So nothing has to be centred beforehand, and large means cost no digits.
    """
    present = [c for c in columns if c in df.columns]
    numbers = coerced(df, present).select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(present)])
    pairs = [
        {"i": str(i), "j": str(j), "x": f"c{i}", "y": f"c{j}"} for i in range(len(present)) for j in range(i, len(present))
    ]
    moments = (
        numbers.selectExpr(sql.rows(pairs))
        .filter("x IS NOT NULL AND y IS NOT NULL")
        .groupBy("i", "j")
        .agg(
            F.covar_pop("x", "y").alias("both"),
            F.stddev_pop("x").alias("sx"),
            F.stddev_pop("y").alias("sy"),
            F.expr("min(x) = max(x) OR min(y) = max(y)").alias("flat"),
        )
    )
    known = {(r["i"], r["j"]): r for r in moments.collect()}  # a row for each pair of columns
    used = [i for i in range(len(present)) if (i, i) in known]
    if len(used) < 2:
        raise ValueError("a correlation matrix needs two columns with values")

    def entry(i: int, j: int) -> float | None:
        found = known.get((min(i, j), max(i, j)))
        if found is None or found["flat"] or not found["sx"] * found["sy"]:
            return None
        return 1.0 if i == j else found["both"] / (found["sx"] * found["sy"])

    schema = T.StructType(
        [T.StructField("column", T.StringType()), *[T.StructField(present[i], T.DoubleType()) for i in used]]
    )
    return df.sparkSession.createDataFrame([(present[i], *[entry(i, j) for j in used]) for i in used], schema)


def moved_trips_in_minutes(df: DataFrame, target: str = "trip_duration") -> DataFrame:
    """Distance and duration in minutes of every complete trip that went anywhere."""
    complete = coerced(df, [*GPS_COLUMNS, target]).na.drop(subset=[*GPS_COLUMNS, target])
    measured = with_distance(complete).withColumn("duration_minutes", minutes(F.col(target)))
    return measured.filter(F.col("distance_km") > 0).select("distance_km", "duration_minutes")


def distance_duration_correlation(df: DataFrame, prob: float = 0.99) -> DataFrame:
    """One row: correlation of distance and duration below both upper percentiles."""
    usual = within_upper_percentile(moved_trips_in_minutes(df), ["distance_km", "duration_minutes"], prob)
    spread = F.stddev_pop("distance_km") * F.stddev_pop("duration_minutes")
    return usual.agg(
        F.count(F.lit(1)).alias("trips"),
        F.try_divide(F.covar_pop("distance_km", "duration_minutes"), spread).alias("correlation"),
    )


def median_minutes_by_hour(df: DataFrame, target: str = "trip_duration") -> DataFrame:
    known = coerced(df, [target]).filter(F.col("pickup_hour").isNotNull())
    medians = quantiles(known, [target], [0.5], by=["pickup_hour"])
    return medians.select("pickup_hour", minutes(F.get("quantiles", F.lit(0))).alias("median_minutes")).orderBy(
        "pickup_hour"
    )


def rush_hour_summary(df: DataFrame, target: str = "trip_duration") -> DataFrame:
    """Trips, mean and median minutes inside and outside rush hour."""
    flagged = coerced(df, [target]).select(rush_hour(F.col("pickup_hour")).alias("rush_hour"), target)
    means = flagged.groupBy("rush_hour").agg(
        F.count(target).alias("trips"), minutes(F.avg(target)).alias("mean_minutes")
    )
    medians = quantiles(flagged, [target], [0.5], by=["rush_hour"]).select(
        "rush_hour", minutes(F.get("quantiles", F.lit(0))).alias("median_minutes")
    )
    return means.join(medians, "rush_hour", "left").orderBy("rush_hour")


def histogram(df: DataFrame, column: str, bins: int = 50, upper_prob: float = 0.99) -> DataFrame:
    """Equal-width bins from the smallest value to the upper percentile; empty bins count 0."""
    limits = quantile_values(df, [column], [0.0, upper_prob])[column]
    if limits[0] is None:
        raise ValueError(f"{column} has no value")
    usual = df.selectExpr(f"{sql.plain_number(df, column)} AS v").filter(F.col("v") <= F.lit(limits[1]))
    low, high = usual.agg(F.min("v"), F.max("v")).first()
    if math.isinf(low) or math.isinf(high):
        raise ValueError(f"{column} has infinite values, which fit no bin")
    if low == high:
        low, high = low - 0.5, high + 0.5
    place = F.least(F.floor((F.col("v") - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    counts = usual.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / bins
    return (
        grid.join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * width).alias("bin_start"),
            (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("trips"),
        )
        .orderBy("bin")
    )
