import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import trip, trip_table

from tripforge.functions import calendar, measures
from tripforge.operators import enrich, validate
from tripforge.operators.validate import InvalidTable


def at(text):
    return datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def trips(spark):
    raw = trip_table(
        spark,
        trip(id="a", pickup_datetime="2016-01-01 08:10:00"),
        trip(id="b", pickup_datetime="2016-01-01 08:12:00"),
        trip(id="c", pickup_datetime="2016-01-01 05:00:00"),
    )
    return validate.valid_trips(raw)


@pytest.fixture(scope="module")
def weather(spark):
    rows = [
        ("2016-01-01 08:01:00", "2.0", "1", "x", "late"),
        ("2016-01-01 08:59:00", "4.0", "nan", "x", "late"),
        ("never", "9.0", "1", "1", "late"),
    ]
    return spark.createDataFrame(rows, "pickup_datetime string, tempm string, precipm string, wspdm string, conds string")


def test_hourly_means_skip_missing_values(weather):
    rows = enrich.hourly_weather(weather).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["temperature_c"], row["precipitation_mm"]) == (3.0, 1.0)
    assert row["wind_speed_kmh"] is None and row["visibility_km"] is None


@pytest.mark.parametrize("bound", [enrich.BROADCAST_HOURS, 0])
def test_join_keeps_every_trip_once(trips, weather, bound):
    joined = enrich.with_weather(trips, weather, broadcast_hours=bound)
    found = {r["id"]: (r["temperature_c"], r["weather_data_available"]) for r in joined.collect()}
    assert found == {"a": (3.0, 1), "b": (3.0, 1), "c": (None, 0)}
    assert joined.count() == 3


def test_broadcast_only_within_the_bound(trips, weather):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(enrich.with_weather(trips, weather))
    assert "_salt" in plan(enrich.with_weather(trips, weather, broadcast_hours=0))


def test_a_busy_hour_joins_the_same_way(spark, weather):
    busy = [trip(id=f"h{i}", pickup_datetime=f"2016-01-01 08:{i % 15:02d}:00") for i in range(300)]
    trips = validate.valid_trips(trip_table(spark, *busy, trip(id="q", pickup_datetime="2016-01-01 03:00:00")))
    salted = enrich.with_weather(trips, weather, broadcast_hours=0).orderBy("id").collect()
    assert salted == enrich.with_weather(trips, weather).orderBy("id").collect()
    assert sum(r["weather_data_available"] for r in salted) == 300


def test_no_weather(trips):
    rows = enrich.with_weather(trips, None).collect()
    assert all(r["temperature_c"] is None and r["weather_data_available"] == 0 for r in rows)


def test_weather_without_time_or_with_both_names(spark):
    with pytest.raises(InvalidTable, match="must contain"):
        enrich.hourly_weather(spark.createDataFrame([(1.0,)], "tempm double"))
    with pytest.raises(InvalidTable, match="both names"):
        enrich.hourly_weather(spark.createDataFrame([("x", 1.0, 1.0)], "pickup_datetime string, tempm double, temperature_c double"))


def test_calendar_parts(spark):
    moments = [at("2024-01-01 06:59:59"), at("2024-01-06 07:00:00"), at("2024-01-07 20:59:00"), None]
    df = calendar.with_pickup_parts(spark.createDataFrame([(m,) for m in moments], "pickup_datetime timestamp"))
    rows = [tuple(r)[1:] for r in df.collect()]
    assert rows == [
        (6, 1, 1, 0, 0, 0),
        (7, 6, 1, 5, 1, 1),
        (20, 7, 1, 6, 1, 1),
        (None, None, None, None, 0, 0),
    ]


def test_rush_hours(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("h"))
    flagged = hours.filter(calendar.rush_hour(F.col("h")) == 1).collect()
    assert [r["h"] for r in flagged] == [7, 8, 9, 10, 16, 17, 18, 19, 20]
    form = hours.filter(calendar.rush_hour(F.col("h"), F.lit(4), calendar.FORM_RUSH_HOURS) == 1).collect()
    assert [r["h"] for r in form] == [7, 8, 9, 16, 17, 18, 19]
    assert hours.filter(calendar.rush_hour(F.col("h"), F.lit(5), calendar.FORM_RUSH_HOURS) == 1).count() == 0


def test_weekday_names(spark):
    df = spark.createDataFrame([(0,), (6,), (7,), (None,)], "d int").select(calendar.weekday_name(F.col("d")).alias("n"))
    assert [r["n"] for r in df.collect()] == ["Monday", "Sunday", None, None]


def test_form_parts(spark):
    df = spark.createDataFrame([("2026-01-15", "18:30")], "d string, t string")
    row = df.select(*[v.alias(k) for k, v in calendar.form_parts(F.col("d"), F.col("t")).items()]).first()
    assert row.asDict() == {
        "pickup_hour": 18,
        "pickup_day": 15,
        "pickup_month": 1,
        "pickup_weekday": 3,
        "is_weekend": 0,
        "rush_hour": 1,
    }


def brute_distance(lat1, lon1, lat2, lon2):
    a, b = math.radians(lat1), math.radians(lat2)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    h = min(h, 1.0)
    return 2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def test_haversine(spark):
    points = [(40.75, -73.98, 40.76, -73.97), (0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0), (-33.9, 18.4, 51.5, -0.1)]
    df = spark.createDataFrame([*points, (None, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    found = df.select(measures.haversine_km(*[F.col(c) for c in "abcd"]).alias("km")).collect()
    for row, point in zip(found, points):
        assert row["km"] == pytest.approx(brute_distance(*point), rel=1e-9, abs=1e-9)
    assert found[-1]["km"] is None


def test_trips_that_go_nowhere_are_dropped(spark):
    still = trip(id="still", dropoff_longitude="-73.871", dropoff_latitude="40.774")
    trips = validate.valid_trips(trip_table(spark, trip(), still))
    assert [r["id"] for r in enrich.enriched_trips(trips).collect()] == ["t1"]


def test_clamp_and_minutes(spark):
    df = spark.createDataFrame([(-5.0,), (600.0,), (None,)], "p double")
    rows = df.select(
        measures.clamped_seconds(F.col("p")).alias("s"),
        measures.rounded_minutes(measures.clamped_seconds(F.col("p"))).alias("m"),
    ).collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.0), (600.0, 10.0), (None, None)]
