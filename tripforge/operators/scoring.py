"""Scoring of request tables: range checks, features, prediction, seconds and minutes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.functions.calendar import is_weekend, rush_hour
from tripforge.functions.measures import any_present, clamped_seconds, level_indicator, rounded_minutes
from tripforge.schema import CATEGORY_LEVELS, WEATHER_MEASURES, level_feature

# Accepted ranges, ends included; None leaves an end open.
REQUIRED_RANGES = {
    "passenger_count": (1, 8),
    "pickup_hour": (0, 23),
    "pickup_day": (1, 31),
    "pickup_month": (1, 12),
    "pickup_weekday": (0, 6),
    "rush_hour": (0, 1),
    "is_weekend": (0, 1),
    "vendor_id": (1, 2),
}
LONGEST_TRIP_KM = 200
NON_NEGATIVE_WEATHER = ["precipitation_mm", "wind_speed_kmh", "visibility_km"]


def _rules() -> dict[str, Column]:
    """What a valid field looks like. An unknown answer is a failure."""
    rules = {c: F.col(c).between(low, high) for c, (low, high) in REQUIRED_RANGES.items()}
    rules["distance_km"] = (F.col("distance_km") > 0) & (F.col("distance_km") <= LONGEST_TRIP_KM)
    rules["store_and_fwd_flag"] = F.col("store_and_fwd_flag").isin("N", "Y")
    for c in NON_NEGATIVE_WEATHER:
        rules[c] = F.col(c).isNull() | (F.col(c) >= 0)
    return rules


def checked_requests(requests: DataFrame) -> DataFrame:
    """Requests with ``_errors``: the fields out of range, in the order of their names. NaN weather counts as missing."""
    floats = [c for c in WEATHER_MEASURES if isinstance(requests.schema[c].dataType, (T.DoubleType, T.FloatType))]
    requests = requests.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})
    failed = [
        F.when(~F.coalesce(valid, F.lit(False)), F.lit(field)) for field, valid in sorted(_rules().items())
    ]
    return requests.withColumn("_errors", F.array_compact(F.array(*failed)))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("_errors") == 0).drop("_errors")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("_errors") > 0)


def request_inputs(requests: DataFrame) -> DataFrame:
    """Model inputs of a request. Weekend and rush hour follow from hour and weekday."""
    return requests.withColumns(
        {
            "is_weekend": is_weekend(F.col("pickup_weekday")),
            "rush_hour": rush_hour(F.col("pickup_hour")),
            "weather_data_available": any_present(*WEATHER_MEASURES),
        }
    )


def with_indicators(requests: DataFrame) -> DataFrame:
    indicators = {
        level_feature(column, level): level_indicator(F.col(column), level, column == "vendor_id").cast("int")
        for column, levels in CATEGORY_LEVELS.items()
        for level in levels
    }
    return requests.withColumns(indicators)


def with_durations(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    seconds = clamped_seconds(F.col(prediction))
    return df.withColumns(
        {"trip_duration_seconds": seconds, "trip_duration_minutes": rounded_minutes(seconds)}
    )


def score_requests(requests: DataFrame, model, key: str = "request_id") -> DataFrame:
    """Durations of all acceptable requests.

    ``model`` is a fitted pipeline that starts with the saved preprocessor, so
    requests are imputed and scaled exactly as the training rows were.
    """
    ready = request_inputs(accepted(checked_requests(requests)))
    return with_durations(model.transform(ready)).select(key, "trip_duration_seconds", "trip_duration_minutes")
