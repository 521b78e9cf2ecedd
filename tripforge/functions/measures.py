"""Distance, duration, indicator and error expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; NULL where a coordinate is missing.

    Rounding can push the haversine out of [0, 1], so it is clamped. It occurs
    once in the expression, so it is worked out once a row.
    """
    lat_from, lat_to = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((lat_to - lat_from) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    raw = F.pow(half_lat, 2.0) + F.cos(lat_from) * F.cos(lat_to) * F.pow(half_lon, 2.0)
    clamped = F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0))
    known = (lat1 + lon1 + lat2 + lon2).isNotNull()
    return F.when(known, F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(clamped)))


def trip_distance_km() -> Column:
    return haversine_km(
        F.col("pickup_latitude"),
        F.col("pickup_longitude"),
        F.col("dropoff_latitude"),
        F.col("dropoff_longitude"),
    )


def minutes(seconds: Column) -> Column:
    return seconds / 60.0


def clamped_seconds(prediction: Column) -> Column:
    """Never below zero; a missing prediction stays missing."""
    return F.when(prediction < 0, 0.0).otherwise(prediction)


def rounded_even(value: Column, places: int = 2) -> Column:
    """Rounded after scaling, halves to the even digit, as NumPy does for arrays."""
    return F.rint(value * 10**places) / 10**places


def rounded_minutes(seconds: Column) -> Column:
    return rounded_even(seconds / 60.0)


def level_indicator(column: Column, level: str, numeric: bool) -> Column:
    """1.0 where the column has this level, else 0.0 (also for unknown levels and NULL)."""
    wanted = F.lit(float(level)) if numeric else F.lit(level)
    return F.coalesce(column == wanted, F.lit(False)).cast("double")


def any_present(*columns: str) -> Column:
    return F.coalesce(*[F.col(c) for c in columns]).isNotNull().cast("int")


def error_columns(actual: str, predicted: str) -> dict[str, Column]:
    error = F.col(actual) - F.col(predicted)
    return {"error": error, "absolute_error": F.abs(error)}
