"""Trips, weather and requests in trip shape, derived row by row from the ``events`` table.

Every row of the table is used. The remainders below only plant the defects
that the rules look for (bad vendors, wrong times, lost positions, copies).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.schema import TRIP_COLUMNS


def events(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """One trip per event, and a second copy of one in 199."""
    event, user = F.col("event_id"), F.col("user_id")

    def every(n):
        return event % n == 0

    seconds = F.floor(F.col("value") * 30.0) + 60
    ends = {
        "id": event.cast("string"),
        "vendor_id": F.when(every(211), 3).otherwise(user % 2 + 1).cast("int"),
        "pickup_datetime": F.col("ts"),
        "trip_duration": seconds,
        "passenger_count": F.when(every(89), 0).otherwise(user % 6 + 1).cast("int"),
        "pickup_longitude": F.when(every(101), None)
        .when(every(103), -191.0)
        .otherwise(-74.02 + (event % 97) * 0.001),
        "pickup_latitude": 40.70 + (event % 83) * 0.001,
        "dropoff_longitude": -74.02 + ((event * 7) % 97) * 0.001,
        "dropoff_latitude": 40.70 + ((event * 11) % 83) * 0.001,
        "store_and_fwd_flag": F.when(F.col("event_type") == "error", "Y").otherwise("N"),
        "dropoff_datetime": F.when(every(97), F.timestamp_add("MINUTE", F.lit(-1), F.col("ts"))).otherwise(
            F.timestamp_add("SECOND", seconds, F.col("ts"))
        ),
    }
    row = F.struct(*[ends[c].alias(c) for c in TRIP_COLUMNS])
    copies = F.array_repeat(row, F.when(every(199), 2).otherwise(1))
    return events(spark, folder).select(F.inline(copies))


def text_trips(spark: SparkSession, folder: str) -> DataFrame:
    """The trips as text, as a CSV file gives them, with some unreadable numbers and times."""
    event = F.col("id").cast("bigint")
    written = trips(spark, folder).withColumns(
        {
            "pickup_datetime": F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss"),
            "dropoff_datetime": F.date_format("dropoff_datetime", "yyyy-MM-dd HH:mm:ss"),
            "vendor_id": F.col("vendor_id").cast("string"),
            "trip_duration": F.col("trip_duration").cast("string"),
            "passenger_count": F.when(event % 61 == 0, "two").otherwise(F.col("passenger_count").cast("string")),
            **{
                c: F.col(c).cast("string")
                for c in ("pickup_longitude", "dropoff_longitude", "dropoff_latitude")
            },
            "pickup_latitude": F.when(event % 67 == 0, "nan").otherwise(F.col("pickup_latitude").cast("string")),
        }
    )
    return written.withColumn(
        "pickup_datetime", F.when(event % 71 == 0, "not-a-timestamp").otherwise(F.col("pickup_datetime"))
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """Observations in the normalized layout; none in hour 3, so some trips stay unmatched."""
    value = F.col("value")
    observed = events(spark, folder).filter((F.col("event_type") == "view") & (F.hour("ts") != 3))
    return observed.select(
        F.col("ts").alias("weather_datetime"),
        (value / 10.0).alias("temperature_c"),
        F.when(F.col("event_id") % 5 != 0, value / 100.0).alias("precipitation_mm"),
        (value / 4.0).alias("wind_speed_kmh"),
        F.lit(10.0).alias("visibility_km"),
    )


def exported_weather(spark: SparkSession, folder: str) -> DataFrame:
    """The same observations as text in the export's layout, without the visibility column."""
    return weather(spark, folder).select(
        F.date_format("weather_datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime"),
        F.col("temperature_c").cast("string").alias("tempm"),
        F.coalesce(F.col("precipitation_mm").cast("string"), F.lit("n/a")).alias("precipm"),
        F.col("wind_speed_kmh").cast("string").alias("wspdm"),
        F.lit("light rain").alias("conds"),
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """One scoring request per event; some fields run out of range."""
    event, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    hour, weekday = F.hour("ts"), F.weekday("ts")
    return events(spark, folder).select(
        event.cast("string").alias("request_id"),
        (user % 9).cast("double").alias("passenger_count"),
        (value / 2.0).alias("distance_km"),
        hour.alias("pickup_hour"),
        F.dayofmonth("ts").alias("pickup_day"),
        F.month("ts").alias("pickup_month"),
        weekday.alias("pickup_weekday"),
        (hour.between(7, 10) | hour.between(16, 20)).cast("int").alias("rush_hour"),
        (weekday >= 5).cast("int").alias("is_weekend"),
        F.when(event % 3 != 0, value / 10.0 - 5.0).alias("temperature_c"),
        F.when(event % 3 != 0, F.when(event % 53 == 0, -1.0).otherwise(value / 100.0)).alias("precipitation_mm"),
        F.when(event % 4 == 0, value / 4.0).alias("wind_speed_kmh"),
        F.lit(None).cast("double").alias("visibility_km"),
        (user % 3 + F.when(event % 2 == 0, 1).otherwise(0)).cast("int").alias("vendor_id"),
        F.when(event % 59 == 0, "X").when(F.col("event_type") == "error", "Y").otherwise("N").alias("store_and_fwd_flag"),
    )
