"""From raw trips to the processed rows and the fitted preprocessor."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.operators.enrich import enriched_trips
from tripforge.operators.features import TripPreprocessor, TripPreprocessorModel, feature_rows, with_feature_id
from tripforge.operators.outliers import Fence, fenced, iqr_fences, target_column
from tripforge.operators.sample import in_test_share
from tripforge.operators.validate import CheckedTrips, InvalidTable, valid_trips, validation_report
from tripforge.schema import CATEGORY_LEVELS, NUMERIC_INPUTS
from tripforge.session import stored
from tripforge.sources.files import read_checked_trips, read_weather, write_report, write_table

TRIMMED_COLUMNS = ["distance_km", "passenger_count"]


@dataclass(frozen=True)
class Prepared:
    """``trips`` are the enriched rows inside all fences; ``processed`` the model's columns; ``report`` the validation's."""

    trips: DataFrame
    processed: DataFrame
    preprocessor: TripPreprocessorModel
    fences: list[Fence]
    report: DataFrame


def usable_trips(raw: DataFrame | CheckedTrips, weather: DataFrame | None = None) -> DataFrame:
    """Valid, distinct and enriched trips, stored once.

    Making them costs the only full shuffle; the quantile passes that follow
    read single columns of the stored table.
    """
    rows = raw.rows if isinstance(raw, CheckedTrips) else valid_trips(raw)
    return stored(enriched_trips(rows, weather), "usable-trips")


def trimmed_trips(usable: DataFrame, target: str | None = None) -> tuple[DataFrame, list[Fence]]:
    """Rows inside the IQR fences of distance, then passengers, then the target."""
    target = target or target_column(usable)
    fences = iqr_fences(usable, [*TRIMMED_COLUMNS, *([target] if target else [])])
    return fenced(usable, fences), fences


def prepare(
    raw: DataFrame | CheckedTrips,
    weather: DataFrame | None = None,
    fit_on: str = "train",
    test_share: float = 0.2,
    seed: int = 42,
    key: str = "id",
) -> Prepared:
    """Validate, enrich, trim, fit and transform.

    ``fit_on="train"`` learns the preprocessor from training rows only, so no test
    row leaks into it; ``fit_on="all"`` learns from every row. Raises where no row
    is valid, as nothing could be learned.

    Trips that were checked before (``check_trips``, ``read_checked_trips``) bring
    their rows and report along; the report of raw ones is made when it is read.
    """
    usable = usable_trips(raw, weather)
    if usable.isEmpty():
        raise InvalidTable("no valid trip is left")
    report = raw.report if isinstance(raw, CheckedTrips) else validation_report(raw)
    trips, fences = trimmed_trips(usable)
    target = target_column(trips)
    inputs = trips.select(key, *NUMERIC_INPUTS, *CATEGORY_LEVELS, *([target] if target else []))
    seen = inputs.filter(~in_test_share(key, test_share, seed)) if fit_on == "train" else inputs
    estimator = TripPreprocessor(passthroughCols=[key, *([target] if target else [])])
    preprocessor = estimator.fit(seen)
    return Prepared(trips, preprocessor.transform(inputs), preprocessor, fences, report)


def prepare_files(spark: SparkSession, trips: str, weather: str, folder: str, **options) -> Prepared:
    """Check a trip file, write its report, prepare the rows and write them beside it."""
    checked = read_checked_trips(spark, trips)
    write_report(checked.report, f"{folder}/validation_report")
    checked.require_rows()
    prepared = prepare(checked, read_weather(spark, weather), **options)
    write_table(prepared.processed, f"{folder}/processed")
    return prepared


def build_feature_table(processed: DataFrame, path: str) -> DataFrame:
    """Write the feature table in one partitioned pass and read it back."""
    with_feature_id(feature_rows(processed)).write.mode("overwrite").parquet(path)
    return processed.sparkSession.read.parquet(path)


def hourly_trip_profile(raw: DataFrame, weather: DataFrame | None) -> DataFrame:
    """Per pickup hour: trips, median minutes, mean distance, share of trips with weather."""
    from tripforge.functions.calendar import pickup_parts
    from tripforge.operators.enrich import with_distance, with_weather
    from tripforge.operators.profile import median_minutes_by_hour

    trips = with_distance(with_weather(valid_trips(raw), weather))
    hour = pickup_parts(F.col("pickup_datetime"))["pickup_hour"]
    trips = trips.select(hour.alias("pickup_hour"), "trip_duration", "distance_km", "weather_data_available")
    trips = stored(trips, "hourly-profile")
    means = trips.groupBy("pickup_hour").agg(
        F.count(F.lit(1)).alias("trips"),
        F.avg("distance_km").alias("mean_km"),
        F.avg("weather_data_available").alias("weather_share"),
    )
    return means.join(median_minutes_by_hour(trips), "pickup_hour").orderBy("pickup_hour")
