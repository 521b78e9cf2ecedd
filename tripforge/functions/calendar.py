"""Calendar parts of a pickup time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripforge.schema import WEEKDAY_NAMES

# Inclusive hour ranges that count as rush hour.
RUSH_HOURS = ((7, 10), (16, 20))
# The narrower ranges of the request form, which counts working days only.
FORM_RUSH_HOURS = ((7, 9), (16, 19))


def as_flag(condition: Column) -> Column:
    """1 where the condition holds; 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def hour_start(moment: Column) -> Column:
    return F.date_trunc("HOUR", moment)


def is_weekend(weekday: Column) -> Column:
    return as_flag(weekday >= 5)


def rush_hour(hour: Column, weekday: Column | None = None, ranges=RUSH_HOURS) -> Column:
    """1 inside any range; with ``weekday`` given, on Monday to Friday only."""
    inside = F.lit(False)
    for first, last in ranges:
        inside = inside | hour.between(first, last)
    if weekday is not None:
        inside = inside & (weekday < 5)
    return as_flag(inside)


def weekday_name(weekday: Column) -> Column:
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.when(weekday.between(0, 6), F.get(names, weekday))


def pickup_parts(moment: Column) -> dict[str, Column]:
    """Hour, day, month, weekday (Monday is 0) and the two flags made from them."""
    hour, weekday = F.hour(moment), F.weekday(moment)
    return {
        "pickup_hour": hour,
        "pickup_day": F.dayofmonth(moment),
        "pickup_month": F.month(moment),
        "pickup_weekday": weekday,
        "is_weekend": is_weekend(weekday),
        "rush_hour": rush_hour(hour),
    }


def with_pickup_parts(df: DataFrame, column: str = "pickup_datetime") -> DataFrame:
    return df.withColumns(pickup_parts(F.col(column)))


def joined_date_time(date: Column, time: Column) -> Column:
    """One timestamp from a date and a time of day given as ``HH:mm`` or ``HH:mm:ss`` text."""
    text = F.concat_ws(" ", date.cast("date").cast("string"), time)
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")),
    )


def form_parts(date: Column, time: Column) -> dict[str, Column]:
    """Pickup parts from a form's separate date and time, by the form's own rush-hour rule."""
    moment = joined_date_time(date, time)
    parts = pickup_parts(moment)
    parts["rush_hour"] = rush_hour(F.hour(moment), F.weekday(moment), FORM_RUSH_HOURS)
    return parts
