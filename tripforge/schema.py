"""Column names, schemas and vocabularies shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# The layout of a trip table.
TRIP_COLUMNS = [
    "id",
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "store_and_fwd_flag",
    "trip_duration",
]

# The order in which absent trip columns are reported.
REQUIRED_TRIP_COLUMNS = [
    "id",
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "passenger_count",
    "store_and_fwd_flag",
    "trip_duration",
]

# The shorter list that an older trip layout must carry.
MINIMAL_TRIP_COLUMNS = [
    "pickup_datetime",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "passenger_count",
]

GPS_COLUMNS = [
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
]
NUMBER_COLUMNS = [*GPS_COLUMNS, "passenger_count", "trip_duration", "vendor_id"]
TIME_COLUMNS = ["pickup_datetime", "dropoff_datetime"]
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss",)

# Weather measures and the names an export may give them.
WEATHER_TIME = "weather_datetime"
WEATHER_MEASURES = [
    "temperature_c",
    "precipitation_mm",
    "wind_speed_kmh",
    "visibility_km",
]
WEATHER_ALIASES = {
    "pickup_datetime": "weather_datetime",
    "tempm": "temperature_c",
    "precipm": "precipitation_mm",
    "wspdm": "wind_speed_kmh",
    "vism": "visibility_km",
}

# Target names, looked up in this order.
TARGET_NAMES = ["trip_duration", "duration", "ETA"]
TARGET = "trip_duration"

WEEKDAY_NAMES = [
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
    "Sunday",
]

# Model inputs. Categories carry a closed vocabulary, so a level
# that a data set happens to lack still has its column.
NUMERIC_INPUTS = [
    "passenger_count",
    "distance_km",
    "pickup_hour",
    "pickup_day",
    "pickup_month",
    "pickup_weekday",
    "rush_hour",
    "is_weekend",
    "temperature_c",
    "precipitation_mm",
    "wind_speed_kmh",
    "visibility_km",
    "weather_data_available",
]
CATEGORY_LEVELS = {
    "vendor_id": ["1", "2"],
    "store_and_fwd_flag": ["N", "Y"],
}


def numeric_feature(column: str) -> str:
    return f"num__{column}"


def level_feature(column: str, level: str) -> str:
    return f"cat__{column}_{level}"


FEATURE_COLUMNS = [numeric_feature(c) for c in NUMERIC_INPUTS] + [
    level_feature(c, level) for c, levels in CATEGORY_LEVELS.items() for level in levels
]

# Features watched for drift.
DRIFT_FEATURES = [
    "num__distance_km",
    "num__pickup_hour",
    "num__pickup_weekday",
    "num__temperature_c",
    "num__precipitation_mm",
    "num__wind_speed_kmh",
    "num__visibility_km",
]

# Columns of the correlation matrix.
CORRELATION_COLUMNS = [
    "passenger_count",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "pickup_hour",
    "pickup_day",
    "pickup_month",
    "pickup_weekday",
    "is_weekend",
    "trip_duration",
]

# What the feature table's documentation says of each column.
FEATURE_DESCRIPTIONS = [
    ("num__passenger_count", "numeric", "Passenger count"),
    ("num__distance_km", "numeric", "Trip distance in kilometres"),
    ("num__pickup_hour", "numeric", "Pickup hour"),
    ("num__pickup_day", "numeric", "Pickup day of month"),
    ("num__pickup_month", "numeric", "Pickup month"),
    ("num__pickup_weekday", "numeric", "Pickup weekday"),
    ("num__rush_hour", "numeric", "Rush-hour indicator"),
    ("num__is_weekend", "numeric", "Weekend indicator"),
    ("num__temperature_c", "numeric", "Hourly temperature in Celsius"),
    ("num__precipitation_mm", "numeric", "Hourly precipitation in millimetres"),
    ("num__wind_speed_kmh", "numeric", "Hourly wind speed in kilometres per hour"),
    ("num__visibility_km", "numeric", "Hourly visibility in kilometres"),
    ("num__weather_data_available", "binary", "Whether weather observations matched pickup hour"),
    ("cat__vendor_id_1", "binary", "Vendor 1 indicator"),
    ("cat__vendor_id_2", "binary", "Vendor 2 indicator"),
    ("cat__store_and_fwd_flag_N", "binary", "Store-and-forward N indicator"),
    ("cat__store_and_fwd_flag_Y", "binary", "Store-and-forward Y indicator"),
    ("trip_duration", "target", "Trip duration in seconds"),
]


def text_schema(columns: list[str]) -> T.StructType:
    """Every column as text: files are read without guessing types."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


METADATA_SCHEMA = T.StructType(
    [
        T.StructField("feature_name", T.StringType(), False),
        T.StructField("feature_type", T.StringType(), False),
        T.StructField("description", T.StringType()),
    ]
)

FEATURE_TABLE_SCHEMA = T.StructType(
    [T.StructField("feature_id", T.LongType()), T.StructField("id", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in [*FEATURE_COLUMNS, TARGET]]
)

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("pickup_hour", T.IntegerType()),
        T.StructField("pickup_day", T.IntegerType()),
        T.StructField("pickup_month", T.IntegerType()),
        T.StructField("pickup_weekday", T.IntegerType()),
        T.StructField("rush_hour", T.IntegerType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("precipitation_mm", T.DoubleType()),
        T.StructField("wind_speed_kmh", T.DoubleType()),
        T.StructField("visibility_km", T.DoubleType()),
        T.StructField("vendor_id", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
    ]
)
