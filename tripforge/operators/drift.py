"""Distribution drift between two tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripforge.functions import sqltext as sql
from tripforge.functions.coerce import finite_or_null
from tripforge.operators.quantiles import quantile_values
from tripforge.schema import DRIFT_FEATURES

BINS = 10
FLOOR = 1e-6
THRESHOLD = 0.20


def watched_features(df: DataFrame, features: Sequence[str] = DRIFT_FEATURES) -> list[str]:
    present = [f for f in features if f in df.columns]
    if not present:
        raise ValueError("none of the watched features is in the table")
    return present


def _bin_edges(reference: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Distinct quantiles of the reference per feature; few enough for the driver."""
    probs = [i / bins for i in range(bins + 1)]
    finite = reference.select(*[finite_or_null(f).alias(f) for f in features])
    return {f: sorted({e for e in edges if e is not None}) for f, edges in quantile_values(finite, features, probs).items()}


def _bin_of(value: str, edges: list[float]) -> str:
    """Bins are closed on the left; the outer two are open-ended. Values that are not finite have none."""
    if len(edges) < 2:
        return "CAST(NULL AS INT)"
    place = " + ".join(["0", *[f"CAST({value} >= {sql.double(edge)} AS INT)" for edge in edges[1:-1]]])
    return f"CASE WHEN abs({value}) < {sql.double(math.inf)} THEN {place} END"


def _tallied(df: DataFrame, edges: dict[str, list[float]], by: Sequence[str] = ()) -> DataFrame:
    """Per group and feature: rows by bin, present values and their sum, from one scan that combines on the map side."""
    numbers = df.select(*by, *[F.expr(sql.plain_number(df, f)).alias(f"_v{i}") for i, f in enumerate(edges)])
    entries = [
        {"feature": sql.text(f), "bin": _bin_of(f"_v{i}", cuts), "value": f"_v{i}"} for i, (f, cuts) in enumerate(edges.items())
    ]
    by_bin = (
        numbers.select(*by, F.expr(sql.rows(entries)))
        .groupBy(*by, "feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("present"), F.sum("value").alias("total"))
    )
    pair = F.when(F.col("bin").isNotNull(), F.struct("bin", "n"))
    return by_bin.groupBy(*by, "feature").agg(
        F.map_from_entries(F.collect_list(pair)).alias("counts"), F.sum("present").alias("present"), F.sum("total").alias("total")
    )


def reference_profile(reference: DataFrame, features: Sequence[str], bins: int = BINS) -> DataFrame:
    """What later comparisons need of a reference: one row per feature with edges, rows by bin, present values and sum.

    Written once, it stands for the reference: comparing reads the current side only.
    """
    edges = _bin_edges(reference, list(features), bins)
    spark = reference.sparkSession
    known = spark.createDataFrame([(f, cuts) for f, cuts in edges.items()], "feature string, edges array<double>")
    return known.join(_tallied(reference, edges), "feature", "left")


def merged_profiles(left: DataFrame, right: DataFrame) -> DataFrame:
    """The profile of two tables together that were counted by the same edges; raises where edges differ."""
    both = left.join(right.select("feature", *[F.col(c).alias(f"_{c}") for c in ("edges", "counts", "present", "total")]), "feature")
    if left.count() != right.count() or not both.count() == left.count() == both.filter("edges <=> _edges").count():
        raise ValueError("profiles merge only where they have the same features and edges")
    counts = F.expr("map_zip_with(coalesce(counts, CAST(map() AS map<int, bigint>)), coalesce(_counts, CAST(map() AS map<int, bigint>)), (k, a, b) -> coalesce(a, 0L) + coalesce(b, 0L))")
    return both.select(
        "feature",
        "edges",
        counts.alias("counts"),
        (F.coalesce("present", F.lit(0)) + F.coalesce("_present", F.lit(0))).alias("present"),
        F.coalesce(F.col("total") + F.col("_total"), "total", "_total").alias("total"),
    )


def profile_of(current: DataFrame, like: DataFrame) -> DataFrame:
    """The profile of another table by the edges of ``like``."""
    edges = {r["feature"]: list(r["edges"]) for r in like.select("feature", "edges").collect()}
    return like.select("feature", "edges").join(_tallied(current, edges), "feature", "left")


def _psi(edges: str, reference: str, current: str) -> Column:
    """Population stability index of two maps of bin counts; 0 without two edges or without rows on a side."""

    def total(counts: str) -> Column:
        return F.expr(f"aggregate(map_values({counts}), 0L, (a, n) -> a + n)")

    def share(counts: str, bin: Column) -> Column:
        # try_element_at gives NULL for a bin without rows.
        return F.greatest(F.try_divide(F.coalesce(F.try_element_at(F.col(counts), bin), F.lit(0)), total(counts)), F.lit(FLOOR))

    def term(bin: Column) -> Column:
        expected, actual = share(reference, bin), share(current, bin)
        return (actual - expected) * F.ln(actual / expected)

    bins = F.sequence(F.lit(0), F.size(edges) - 2)
    value = F.aggregate(F.transform(bins, term), F.lit(0.0), lambda a, b: a + b)
    usable = (F.size(edges) >= 2) & (total(reference) > 0) & (total(current) > 0)
    return F.coalesce(F.when(usable, value), F.lit(0.0))


def compared(profile: DataFrame, current: DataFrame, by: Sequence[str] = (), threshold: float = THRESHOLD) -> DataFrame:
    """Means of both sides, relative shift, PSI and the drift flag per watched feature.

    ``profile`` is a stored reference profile. With ``by`` columns, each of their
    values is a table of its own: many are compared in one scan.
    """
    edges = {r["feature"]: list(r["edges"]) for r in profile.select("feature", "edges").collect()}
    known = profile.select(
        "feature", F.col("edges").alias("_edges"), F.col("counts").alias("_counts"), (F.try_divide("total", "present")).alias("reference_mean")
    )
    tallied = _tallied(current, edges, by)
    # A profile has one row per feature. A current table without rows still gets a row for each.
    sides = tallied.join(F.broadcast(known), "feature") if by else known.join(tallied, "feature", "left")
    measured = sides.select(
        *by, "feature", "reference_mean", F.try_divide("total", "present").alias("current_mean"), _psi("_edges", "_counts", "counts").alias("psi")
    )
    shift = F.abs(F.col("current_mean") - F.col("reference_mean"))
    return measured.select(
        *by,
        "feature",
        "reference_mean",
        "current_mean",
        (shift / F.greatest(F.abs("reference_mean"), F.lit(1e-6))).alias("relative_mean_shift"),
        "psi",
        (F.col("psi") >= threshold).alias("drift_detected"),
    )


def psi(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = BINS) -> DataFrame:
    """Population stability index per feature, over quantile bins of the reference.

    A feature with no finite value on either side, or with a single distinct
    edge, gets 0.
    """
    return compared(reference_profile(reference, features, bins), current).select("feature", "psi")


def drift_metrics(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] = DRIFT_FEATURES,
    bins: int = BINS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Means of both sides, relative shift, PSI and the drift flag per watched feature.

    Beside the quantiles, either side is read once: bins and means come from one pass.
    """
    watched = watched_features(reference, features)
    return compared(reference_profile(reference, watched, bins), current, threshold=threshold)


def drift_report(
    metrics: DataFrame,
    threshold: float = THRESHOLD,
    input: str | None = None,
    seed: int | None = None,
    sample_size: int | None = None,
) -> DataFrame:
    """One row: drifted features in the order of their names, whether to retrain, and what was compared."""
    return metrics.agg(
        F.count(F.lit(1)).alias("watched_features"),
        F.sort_array(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))).alias("drifted_features"),
        F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("retraining_triggered"),
    ).withColumns(
        {
            "psi_threshold": F.lit(threshold),
            "input": F.lit(input).cast("string"),
            "seed": F.lit(seed).cast("bigint"),
            "sample_size": F.lit(sample_size).cast("bigint"),
        }
    )
