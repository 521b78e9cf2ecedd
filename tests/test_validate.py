import pytest
from rows import trip, trip_table

from tripforge.operators import validate
from tripforge.operators.validate import InvalidTable


def report(df):
    return validate.validation_report(df).first().asDict()


def test_missing_gps_and_bad_time_are_removed(spark):
    raw = trip_table(spark, trip(), trip(id="t2", pickup_longitude=None), trip(id="t3", pickup_datetime="not-a-timestamp"))
    found = report(raw)
    assert found["missing_gps_rows"] == 1
    assert found["invalid_timestamp_rows"] == 1
    assert found["invalid_coordinate_rows"] == 1  # the missing longitude again
    assert (found["input_rows"], found["removed_rows"], found["output_rows"]) == (3, 2, 1)
    assert found["status"] == "passed"
    assert [r["id"] for r in validate.valid_trips(raw).collect()] == ["t1"]


def test_absent_columns_are_named_in_order(spark):
    with pytest.raises(InvalidTable, match="Missing required columns: vendor_id, pickup_datetime"):
        validate.valid_trips(spark.createDataFrame([("t1",)], "id string"))


@pytest.mark.parametrize(
    ("changes", "rule"),
    [
        ({"dropoff_datetime": "2019-11-23 06:41:19"}, "invalid_timestamp_rows"),
        ({"dropoff_datetime": None}, "invalid_timestamp_rows"),
        ({"pickup_latitude": "90.01"}, "invalid_coordinate_rows"),
        ({"dropoff_longitude": "-180.5"}, "invalid_coordinate_rows"),
        ({"pickup_longitude": "inf"}, "invalid_coordinate_rows"),
        ({"passenger_count": "0"}, "invalid_value_rows"),
        ({"passenger_count": "many"}, "invalid_value_rows"),
        ({"trip_duration": "-1"}, "invalid_value_rows"),
        ({"vendor_id": "3"}, "invalid_value_rows"),
        ({"vendor_id": None}, "invalid_value_rows"),
        ({"dropoff_latitude": "nan"}, "missing_gps_rows"),
    ],
)
def test_each_rule(spark, changes, rule):
    found = report(trip_table(spark, trip(), trip(id="bad", **changes)))
    assert found[rule] == 1
    assert found["removed_rows"] == 1


@pytest.mark.parametrize(
    "changes",
    [
        {"dropoff_datetime": "2019-11-23 06:41:20"},
        {"pickup_latitude": "90"},
        {"dropoff_longitude": "-180"},
        {"trip_duration": "0"},
        {"vendor_id": "2"},
    ],
)
def test_limits_are_valid(spark, changes):
    assert report(trip_table(spark, trip(**changes)))["removed_rows"] == 0


def test_duplicates_are_counted_on_text_and_dropped_after_coercion(spark):
    raw = trip_table(spark, trip(), trip(), trip(passenger_count="3.0"))
    found = report(raw)
    assert found["duplicate_rows"] == 1
    assert found["output_rows"] == 1
    assert validate.duplicate_count(raw).first()[0] == 1


def test_nulls_are_equal_among_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert validate.duplicate_count(df).first()[0] == 1


def test_no_row_left(spark):
    checked = validate.check_trips(trip_table(spark, trip(vendor_id="9")))
    assert checked.report.first()["status"] == "failed"
    with pytest.raises(InvalidTable, match="removed every row"):
        checked.require_rows()


def test_empty_table(spark):
    found = report(trip_table(spark))
    assert found["input_rows"] == found["duplicate_rows"] == found["output_rows"] == 0
    assert found["status"] == "failed"


def test_hot_copies_do_not_change_the_report(spark):
    raw = trip_table(spark, *[trip()] * 500, *[trip(id=f"x{i}") for i in range(50)]).repartition(7)
    found = report(raw)
    assert found["duplicate_rows"] == 499
    assert found["output_rows"] == 51


def test_shorter_layout(spark):
    from tripforge.schema import MINIMAL_TRIP_COLUMNS

    raw = trip_table(spark, trip())
    validate.require_columns(raw, MINIMAL_TRIP_COLUMNS)
    with pytest.raises(InvalidTable, match="passenger_count"):
        validate.require_columns(raw.drop("passenger_count"), MINIMAL_TRIP_COLUMNS)


def test_type_suffixes_and_hexadecimal_text_are_no_numbers(spark):
    from tripforge.functions.coerce import number

    texts = ["1d", "5F", "0x1p3", " 2.5 ", "-1e3", ".5", "7.", "Infinity", "-inf", "NaN", "", "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.select(number(df, "t").alias("v"), "i").orderBy("i").collect()]
    assert got == [None, None, None, 2.5, -1000.0, 0.5, 7.0, float("inf"), float("-inf"), None, None, None]


def test_rows_and_report_come_from_one_stored_table(spark):
    raw = trip_table(spark, trip(), trip(), trip(id="x", vendor_id="7"))
    checked = validate.check_trips(raw)
    assert checked.report.first() == validate.validation_report(raw).first()
    assert checked.rows.columns == raw.columns and checked.rows.count() == 1
    assert len(checked.rows.inputFiles()) > 0 and checked.rows.inputFiles() == checked.report.inputFiles()
