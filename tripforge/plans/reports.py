"""The exploratory report and the drift report as sets of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.functions.calendar import with_pickup_parts
from tripforge.functions.coerce import coerced
from tripforge.operators import drift, profile
from tripforge.operators.sample import sample_rows
from tripforge.operators.validate import duplicate_count
from tripforge.schema import NUMBER_COLUMNS, TIME_COLUMNS, TIME_FORMATS
from tripforge.session import stored
from tripforge.sources.files import write_report, write_table, write_tables


def typed_trips(raw: DataFrame, formats=TIME_FORMATS) -> DataFrame:
    """Raw trips with numbers and times read where they can be; no row is dropped."""
    present = [c for c in NUMBER_COLUMNS if c in raw.columns]
    times = [c for c in TIME_COLUMNS if c in raw.columns]
    return with_pickup_parts(coerced(raw, present, times, formats))


def exploratory_report(raw: DataFrame) -> dict[str, DataFrame]:
    """Every exploratory table of a raw trip table.

    The typed rows are stored once as Parquet: each statistic then reads its own
    few columns instead of parsing the text again.
    """
    trips = stored(typed_trips(raw), "typed-trips")
    distances = profile.city_distances(trips)
    in_minutes = trips.select((F.col("trip_duration") / 60.0).alias("duration_minutes"))
    return {
        "shape": profile.row_and_column_count(raw),
        "duplicates": duplicate_count(raw),
        "missing_values": profile.missing_summary(raw),
        "numeric_summary": profile.describe(trips.select(*[c for c in NUMBER_COLUMNS if c in trips.columns])),
        "value_counts": profile.value_counts(trips),
        "invalid_timestamps": profile.missing_times(trips),
        "trips_by_hour": profile.counts_by(trips, "pickup_hour"),
        "trips_by_weekday": profile.counts_by_weekday(trips),
        "trips_by_month": profile.counts_by(trips, "pickup_month"),
        "trips_by_passengers": profile.counts_by_passengers(trips),
        "gps_summary": profile.gps_summary(trips),
        "distance_summary": profile.describe(distances, ["distance_km"]),
        "distance_histogram": profile.histogram(distances, "distance_km"),
        "duration_summary": profile.describe(trips, ["trip_duration"]),
        "duration_histogram": profile.histogram(in_minutes, "duration_minutes"),
        "distance_duration": profile.distance_duration_correlation(trips),
        "median_minutes_by_hour": profile.median_minutes_by_hour(trips),
        "correlation_matrix": profile.correlation_matrix(trips),
        "rush_hours": profile.rush_hour_summary(trips),
    }


def write_exploratory_report(raw: DataFrame, folder: str) -> None:
    write_tables(exploratory_report(raw), folder, "csv")


def drift_tables(
    reference: DataFrame,
    current: DataFrame,
    key: str | None = None,
    sample_size: int | None = None,
    seed: int = 42,
    threshold: float = drift.THRESHOLD,
    input: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Drift report and metrics of two tables, or of equal-sized samples of them, which are drawn by ``key``.

    The report names the ``input``, the seed and the sample size that it was made with.
    """
    if sample_size is not None and key is None:
        raise ValueError("a sample needs the key that it is drawn by")
    if sample_size is not None:
        reference = sample_rows(reference, key, sample_size, seed)
        current = sample_rows(current, key, sample_size, seed)
    metrics = drift.drift_metrics(reference, current, threshold=threshold)
    drawn = seed if sample_size is not None else None
    return drift.drift_report(metrics, threshold, input, drawn, sample_size), metrics


def write_drift_report(report: DataFrame, metrics: DataFrame, folder: str) -> None:
    write_table(metrics, f"{folder}/drift_metrics", "csv")
    write_report(report.withColumn("metrics_file", F.lit(f"{folder}/drift_metrics")), f"{folder}/drift_report")
