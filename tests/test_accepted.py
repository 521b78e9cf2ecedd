"""Loads judged one after another against the same rows judged at once."""

import uuid

import pytest
from plans import plan_text
from pyspark.sql import functions as F
from rows import trip, trip_table

from tripforge.operators import validate
from tripforge.operators.accepted import AcceptedTrips, row_digest
from tripforge.operators.validate import InvalidTable
from tripforge.sources import driver_tables
from tripforge.streaming.validation import arriving_trips, validate_arrivals


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


@pytest.fixture(scope="module")
def raw(spark, small_tables):
    return driver_tables.text_trips(spark, small_tables).cache()


def rows_of(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_two_loads_are_as_good_as_one(spark, raw, path):
    accepted = AcceptedTrips(spark, path, buckets=4)
    third = F.pmod(F.xxhash64("id", "passenger_count"), F.lit(3))
    # The last load holds rows of both others again.
    parts = [raw.filter(third == 0), raw.filter(third == 1), raw.filter(third == 2)]
    reports = [accepted.load(p, f"part-{i}").first() for i, p in enumerate(parts)]
    whole = validate.validation_report(raw).first()
    assert accepted.report().first() == whole
    assert sum(r["output_rows"] for r in reports) == whole["output_rows"]
    assert rows_of(accepted.rows()) == rows_of(validate.valid_trips(raw))
    again = accepted.load(raw, "again").first()
    assert again["output_rows"] == 0 and again["duplicate_rows"] == again["input_rows"] == raw.count()
    assert rows_of(accepted.rows()) == rows_of(validate.valid_trips(raw))


def test_a_load_is_known_in_a_later_session_and_not_repeated(spark, raw, path):
    AcceptedTrips(spark, path, buckets=4).load(raw.limit(50), "first")
    for name in ("raw", "accepted"):
        spark.sql(f"DROP TABLE trips_{name}_{AcceptedTrips(spark, path, 4).name}")
    later = AcceptedTrips(spark, path, buckets=4)
    with pytest.raises(ValueError, match="loaded before"):
        later.load(raw, "first")
    assert later.load(raw.limit(50), "second").first()["duplicate_rows"] == 50


def test_an_interrupted_load_leaves_no_trace(spark, raw, path, monkeypatch):
    accepted = AcceptedTrips(spark, path, buckets=4)
    with monkeypatch.context() as broken:
        broken.setattr("tripforge.operators.accepted.report_of", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            accepted.load(raw, "load")
    with pytest.raises(InvalidTable):
        accepted.require_rows()
    accepted.load(raw, "load")
    assert accepted.report().first() == validate.validation_report(raw).first()
    assert rows_of(accepted.rows()) == rows_of(validate.valid_trips(raw))


def test_quarantine_names_the_rules(spark, path):
    accepted = AcceptedTrips(spark, path, buckets=4)
    bad = trip(id="b", vendor_id="9", pickup_latitude=None)
    accepted.load(trip_table(spark, trip(), bad, bad), "load")
    row = accepted.quarantine().first()
    assert (row["id"], row["copies"]) == ("b", 2)
    assert row["broken_rules"] == ["missing_gps_rows", "invalid_coordinate_rows", "invalid_value_rows"]
    assert accepted.require_rows().rows().count() == 1


def test_old_rows_are_not_shuffled(spark, raw, path):
    accepted = AcceptedTrips(spark, path, buckets=4)
    accepted.load(raw, "load")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(accepted._marked(raw.select(row_digest(raw.columns).alias("_digest")), "raw"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_digests_tell_rows_apart(spark):
    rows = [(None, "a"), ("a", None), ("", "a"), ("a", ""), ("1:a", "-"), ("-", "1:a"), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(row_digest(df.columns)).distinct().count() == len(rows)


def test_arriving_files(spark, raw, path, tmp_path):
    folder, accepted = str(tmp_path / "in"), AcceptedTrips(spark, path, buckets=4)
    for part in range(2):
        raw.filter(F.pmod(F.xxhash64("id"), F.lit(2)) == part).write.mode("append").option("header", True).csv(folder)
        for _ in range(2):  # the second run finds nothing new
            validate_arrivals(arriving_trips(spark, folder, 3), accepted, str(tmp_path / "checkpoint")).awaitTermination()
    assert accepted.report().first() == validate.validation_report(raw).first()
    assert rows_of(accepted.rows()) == rows_of(validate.valid_trips(raw))
