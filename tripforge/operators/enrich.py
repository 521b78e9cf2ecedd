"""Hourly weather and its join to trips; derived trip columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.functions.calendar import hour_start, with_pickup_parts
from tripforge.functions.coerce import coerced
from tripforge.functions.measures import any_present, trip_distance_km
from tripforge.operators.validate import InvalidTable
from tripforge.schema import TIME_FORMATS, WEATHER_ALIASES, WEATHER_MEASURES, WEATHER_TIME

# One row an hour: 200,000 rows of one time and four doubles are under 20 MB and span 22 years.
BROADCAST_HOURS = 200_000
SALTS = 32


def normalized_weather(weather: DataFrame, formats=TIME_FORMATS) -> DataFrame:
    """Either weather layout as time plus four measures; absent measures are NULL."""
    clashes = [old for old, new in WEATHER_ALIASES.items() if old in weather.columns and new in weather.columns]
    if clashes:
        raise InvalidTable(f"weather has both names of: {', '.join(clashes)}")
    named = weather.withColumnsRenamed(WEATHER_ALIASES)
    if WEATHER_TIME not in named.columns:
        raise InvalidTable("weather must contain weather_datetime or pickup_datetime")
    present = [c for c in WEATHER_MEASURES if c in named.columns]
    absent = {c: F.lit(None).cast("double") for c in WEATHER_MEASURES if c not in present}
    typed = coerced(named.select(WEATHER_TIME, *present), present, [WEATHER_TIME], formats)
    return typed.withColumns(absent).select(WEATHER_TIME, *WEATHER_MEASURES)


def hourly_weather(weather: DataFrame, formats=TIME_FORMATS) -> DataFrame:
    """The mean of each measure by hour, so that a trip can match one row at most."""
    return (
        normalized_weather(weather, formats)
        .filter(F.col(WEATHER_TIME).isNotNull())
        .groupBy(hour_start(F.col(WEATHER_TIME)).alias(WEATHER_TIME))
        .agg(*[F.avg(c).alias(c) for c in WEATHER_MEASURES])
    )


def without_weather(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {**{c: F.lit(None).cast("double") for c in WEATHER_MEASURES}, "weather_data_available": F.lit(0)}
    )


def with_weather(
    trips: DataFrame,
    weather: DataFrame | None,
    moment: str = "pickup_datetime",
    broadcast_hours: int = BROADCAST_HOURS,
) -> DataFrame:
    """Left join of trips to the weather of their hour.

    The hourly table is counted first. Up to ``broadcast_hours`` rows it is
    broadcast and the trips are not shuffled. Beyond that both sides shuffle,
    with the hour salted so that a busy hour spreads over ``SALTS`` tasks.
    """
    if weather is None:
        return without_weather(trips)
    hourly = hourly_weather(weather)
    trips = trips.withColumn("_hour", hour_start(F.col(moment)))
    hourly = hourly.withColumnRenamed(WEATHER_TIME, "_hour")
    if hourly.limit(broadcast_hours + 1).count() <= broadcast_hours:
        joined = trips.join(F.broadcast(hourly), "_hour", "left")
    else:
        spread = hourly.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        row_hash = F.xxhash64(*[F.col(c) for c in trips.columns])
        salted = trips.withColumn("_salt", F.pmod(row_hash, F.lit(SALTS)).cast("int"))
        joined = salted.join(spread, ["_hour", "_salt"], "left").drop("_salt")
    return joined.drop("_hour").withColumn("weather_data_available", any_present(*WEATHER_MEASURES))


def with_distance(trips: DataFrame) -> DataFrame:
    return trips.withColumn("distance_km", trip_distance_km())


def enriched_trips(trips: DataFrame, weather: DataFrame | None = None) -> DataFrame:
    """Trips with weather, pickup parts and distance; trips that go nowhere are dropped."""
    ready = with_distance(with_pickup_parts(with_weather(trips, weather)))
    return ready.filter(F.col("distance_km") > 0)
