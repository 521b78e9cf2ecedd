"""Small literal tables."""

from tripforge.schema import TRIP_COLUMNS

TRIP_SCHEMA = (
    "id string, vendor_id string, pickup_datetime string, dropoff_datetime string, passenger_count string, "
    "pickup_longitude string, pickup_latitude string, dropoff_longitude string, dropoff_latitude string, "
    "store_and_fwd_flag string, trip_duration string"
)


def trip(**changes):
    row = {
        "id": "t1",
        "vendor_id": "2",
        "pickup_datetime": "2019-11-23 06:41:20",
        "dropoff_datetime": "2019-11-23 07:02:05",
        "passenger_count": "3",
        "pickup_longitude": "-73.871",
        "pickup_latitude": "40.774",
        "dropoff_longitude": "-73.99",
        "dropoff_latitude": "40.731",
        "store_and_fwd_flag": "Y",
        "trip_duration": "1245",
    }
    row.update(changes)
    return tuple(row[c] for c in TRIP_COLUMNS)


def trip_table(spark, *rows):
    return spark.createDataFrame(list(rows), TRIP_SCHEMA)
