import pandas as pd
import pytest

from tripforge.operators import outliers


@pytest.fixture(scope="module")
def table(spark):
    pdf = pd.DataFrame(
        {
            "id": range(200),
            "distance_km": [i % 10 + 0.5 for i in range(199)] + [500.0],
            "passenger_count": [1 + i % 3 for i in range(195)] + [9] * 5,
            "trip_duration": [100 + i for i in range(190)] + [50_000] * 10,
        }
    )
    return pdf, spark.createDataFrame(pdf).repartition(5).cache()


def pandas_fence(pdf, column):
    low, high = pdf[column].quantile([0.25, 0.75])
    return pdf[pdf[column].between(low - 1.5 * (high - low), high + 1.5 * (high - low))]


def test_chain_takes_quartiles_of_surviving_rows(table):
    pdf, df = table
    columns = ["distance_km", "passenger_count", "absent", "trip_duration"]
    fences = outliers.iqr_fences(df, columns)
    kept = {r["id"] for r in outliers.fenced(df, fences).collect()}
    expected, removed = pdf, []
    for c in ("distance_km", "passenger_count", "trip_duration"):
        before = len(expected)
        expected = pandas_fence(expected, c)
        removed.append(before - len(expected))
    assert kept == set(expected["id"])
    report = outliers.fence_report(df, fences).orderBy("step").collect()
    assert [r["removed_rows"] for r in report] == removed


def test_bounds_are_inclusive_and_missing_is_dropped(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 4)] + [(7.0,), (None,)], "x double")
    # quartiles 1.25 and 3.75: fence [-2.5, 7.5]
    assert outliers.within_iqr(df, "x").count() == 6
    assert outliers.within_iqr(df, "no_such_column").count() == 7


def test_all_missing_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert outliers.within_iqr(df, "x").count() == 0


def test_upper_percentile_limits_come_before_the_filter(table):
    pdf, df = table
    found = outliers.within_upper_percentile(df, ["distance_km", "trip_duration"], 0.9)
    limits = pdf[["distance_km", "trip_duration"]].quantile(0.9)
    expected = pdf[(pdf["distance_km"] <= limits["distance_km"]) & (pdf["trip_duration"] <= limits["trip_duration"])]
    assert {r["id"] for r in found.collect()} == set(expected["id"])


def test_finite_rows(spark):
    values = [1.0, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r["x"] for r in outliers.finite_rows(df, ["x"]).collect()] == [1.0]


def test_target_lookup(spark):
    df = spark.createDataFrame([(1, 2)], "ETA int, duration int")
    assert outliers.target_column(df) == "duration"
    assert outliers.target_column(df.drop("duration", "ETA")) is None


def test_city_area(spark):
    schema = "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double"
    rows = [(40.0, -75.0, 42.0, -72.0), (39.9, -74.0, 41.0, -74.0), (41.0, -74.0, 41.0, None)]
    assert outliers.in_city(spark.createDataFrame(rows, schema)).count() == 1
