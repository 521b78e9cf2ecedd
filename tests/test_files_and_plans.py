import hashlib
import json
from pathlib import Path

import pandas as pd
import pytest
from plans import plan_text
from pyspark.sql import functions as F
from rows import trip, trip_table

from tripforge.operators import features
from tripforge.operators.profile import value_counts
from tripforge.operators.validate import InvalidTable, valid_trips, validation_report
from tripforge.plans import preparation, reports
from tripforge.schema import FEATURE_COLUMNS, TRIP_COLUMNS
from tripforge.session import cluster_settings, shared_folder, stored, use_checkpoints
from tripforge.sources import driver_tables, files, manifest


def test_csv_round_trip(spark, tmp_path):
    raw = trip_table(spark, trip(), trip(id="t2", pickup_longitude=None))
    path = str(tmp_path / "trips")
    files.write_table(raw, path, "csv")
    assert files.csv_columns(spark, path) == TRIP_COLUMNS
    checked = files.read_checked_trips(spark, path).require_rows()
    assert checked.rows.count() == 1
    assert checked.report.first()["missing_gps_rows"] == 1


def test_csv_columns_in_another_order(spark, tmp_path):
    raw = trip_table(spark, trip()).select(*reversed(TRIP_COLUMNS))
    files.write_table(raw, str(tmp_path / "t"), "csv")
    assert files.read_trips(spark, str(tmp_path / "t")).first()["id"] == "t1"


def test_csv_without_required_columns(spark, tmp_path):
    files.write_table(trip_table(spark, trip()).drop("vendor_id"), str(tmp_path / "t"), "csv")
    with pytest.raises(InvalidTable, match="vendor_id"):
        files.read_trips(spark, str(tmp_path / "t"))


def test_absent_files(spark, tmp_path):
    assert files.read_weather(spark, str(tmp_path / "none.csv")) is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_trips(spark, str(tmp_path / "none.csv"))


def test_report_as_json(spark, tmp_path):
    files.write_report(validation_report(trip_table(spark, trip())), str(tmp_path / "report"))
    (part,) = Path(tmp_path / "report").glob("part-*.json")
    assert json.loads(part.read_text())["status"] == "passed"


def test_feature_metadata(spark, tmp_path):
    files.write_feature_metadata(spark, str(tmp_path / "meta"))
    rows = spark.read.parquet(str(tmp_path / "meta")).collect()
    assert len(rows) == 18
    assert {r["feature_type"] for r in rows} == {"numeric", "binary", "target"}


@pytest.fixture(scope="module")
def prepared(spark, small_tables):
    return preparation.prepare(driver_tables.trips(spark, small_tables), driver_tables.weather(spark, small_tables))


def test_feature_table(spark, prepared, tmp_path):
    path = str(tmp_path / "features")
    table = preparation.build_feature_table(prepared.processed, path)
    assert table.columns == ["feature_id", "id", *FEATURE_COLUMNS, "trip_duration"]
    assert table.count() == table.select("feature_id").distinct().count() == prepared.trips.count()
    two = files.read_features(spark, path, ["num__distance_km", "trip_duration"], key=None)
    plan = plan_text(two)
    assert "ReadSchema: struct<num__distance_km:double,trip_duration:double>" in plan
    preparation.build_feature_table(prepared.processed, path)
    assert spark.read.parquet(path).count() == prepared.trips.count()


def test_preprocessor_is_saved(spark, prepared, tmp_path):
    files.save_model(prepared.preprocessor, str(tmp_path / "pre"))
    again = features.TripPreprocessorModel.load(str(tmp_path / "pre"))
    rows = prepared.trips.select("id", "trip_duration", *again.getOrDefault("numericCols"), "vendor_id", "store_and_fwd_flag")
    assert again.transform(rows).count() == prepared.processed.count()


def test_train_fit_does_not_see_test_rows(spark, small_tables, prepared):
    everything = preparation.prepare(
        driver_tables.trips(spark, small_tables), driver_tables.weather(spark, small_tables), fit_on="all"
    )
    name = "numbers"
    assert everything.preprocessor.getOrDefault(name) != prepared.preprocessor.getOrDefault(name)


def test_fences_reach_the_scan(prepared):
    plan = plan_text(prepared.trips)
    for column in ("distance_km", "passenger_count", "trip_duration"):
        assert f"GreaterThanOrEqual({column}" in plan
    assert "Exchange" not in plan


def test_result_does_not_depend_on_partitions(spark, small_tables):
    raw = driver_tables.trips(spark, small_tables)
    first = validation_report(raw.repartition(1)).first()
    assert first == validation_report(raw.repartition(11)).first()


def test_exploratory_report(spark, small_tables, tmp_path):
    raw = driver_tables.text_trips(spark, small_tables)
    tables = reports.exploratory_report(raw)
    assert len(tables) == 19
    assert tables["shape"].first()["row_count"] == raw.count()
    assert sum(r["trips"] for r in tables["trips_by_hour"].collect()) + tables["invalid_timestamps"].first()[0] == raw.count()
    files.write_tables({k: tables[k] for k in ("missing_values", "correlation_matrix")}, str(tmp_path), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "missing_values")).count() == 11


def test_drift_tables(spark, prepared, tmp_path):
    table = prepared.processed.persist()
    moved = table.withColumn("num__distance_km", F.col("num__distance_km") + 1.0)
    report, metrics = reports.drift_tables(table, moved, key="id", sample_size=300)
    reports.write_drift_report(report, metrics, str(tmp_path))
    assert report.first()["drifted_features"] == ["num__distance_km"]
    assert spark.read.option("header", True).csv(str(tmp_path / "drift_metrics")).count() == 7
    (part,) = Path(tmp_path / "drift_report").glob("part-*.json")
    assert json.loads(part.read_text())["retraining_triggered"] is True


def test_manifest(spark, tmp_path):
    folder = tmp_path / "data"
    trip_table(spark, trip(), trip(id="t2")).repartition(2).write.option("header", True).csv(str(folder))
    rows = manifest.manifest(spark, str(folder)).filter("file LIKE '%part-%'").collect()
    for row in rows:
        content = Path(row["file"].removeprefix("file:")).read_bytes()
        assert row["sha256"] == hashlib.sha256(content).hexdigest()
        assert row["bytes"] == len(content)
        assert row["columns"] == TRIP_COLUMNS and row["table_rows"] == 2


def test_files_are_hashed_in_blocks_whatever_their_length_and_name(spark, tmp_path):
    contents = {"empty.csv": b"", "a b%20é.csv": b"x" * 10, "long one.csv": bytes(range(256)) * 40}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    rows = manifest.file_hashes(spark, str(tmp_path), block_bytes=64).collect()
    assert {(r["bytes"], r["sha256"]) for r in rows} == {(len(c), hashlib.sha256(c).hexdigest()) for c in contents.values()}


def test_a_scheme_that_cannot_be_streamed_is_named():
    hasher = manifest._hasher(64)
    with pytest.raises(ValueError, match="no reader for the scheme of odd://x/y"):
        list(hasher([pd.DataFrame({"file": ["odd://x/y"], "start": [0], "bytes": [1]})]))


def test_fingerprint_ignores_order(spark):
    a = trip_table(spark, trip(), trip(id="t2"), trip(id="t3"))
    b = trip_table(spark, trip(id="t3"), trip(), trip(id="t2")).repartition(3)
    assert manifest.row_fingerprint(a).first() == manifest.row_fingerprint(b).first()
    assert manifest.row_fingerprint(a).first() != manifest.row_fingerprint(a.limit(2)).first()


def test_intermediate_tables_go_to_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    kept = stored(spark.range(5), "numbers")
    assert kept.count() == 5
    assert all(f.startswith(f"file://{folder}/numbers-") for f in kept.inputFiles())
    use_checkpoints(spark)
    assert folder in spark.sparkContext.getCheckpointDir()


def test_cluster_settings_follow_the_input():
    assert cluster_settings(10**9)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_settings(10**13)["spark.sql.shuffle.partitions"] == "37253"
    assert cluster_settings(10**14)["spark.sql.shuffle.partitions"] == "372530"


def test_text_is_parsed_once(spark, tmp_path):
    files.write_table(trip_table(spark, trip()), str(tmp_path / "t"), "csv")
    plan = plan_text(valid_trips(files.read_trips(spark, str(tmp_path / "t"))))
    assert plan.count("gettimestamp(") == 2
    assert plan.count("try_cast(") == 7


def test_one_shuffle_to_valid_trips(spark, small_tables):
    plan = plan_text(valid_trips(driver_tables.trips(spark, small_tables)))
    assert plan.count("Exchange hashpartitioning") == 1


def test_top_values_are_cut_before_the_second_shuffle(spark, small_tables):
    plan = plan_text(value_counts(driver_tables.trips(spark, small_tables)))
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning(column")[1]


def test_a_drift_sample_needs_a_key(spark):
    table = spark.range(3)
    with pytest.raises(ValueError, match="key"):
        reports.drift_tables(table, table, sample_size=2)


def test_markers_of_missing_values(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\nNA,1\nnull,\nN/A,NaN\nNo,nan \n")
    rows = files.read_text_table(spark, str(tmp_path / "t.csv")).collect()
    assert [tuple(r) for r in rows] == [(None, "1"), (None, None), (None, None), ("No", "nan ")]


def test_files_with_another_order_of_columns_fail(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text("id,trip_duration\nt1,900\n")
    (tmp_path / "t" / "b.csv").write_text("trip_duration,id\n800,t2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_text_table(spark, str(tmp_path / "t")).collect()


def test_nothing_valid_to_prepare(spark):
    with pytest.raises(ValueError, match="no valid trip"):
        preparation.prepare(trip_table(spark, trip(trip_duration="-1")))


def test_prepare_files_validates_once_and_reports(spark, small_tables, tmp_path):
    files.write_table(driver_tables.text_trips(spark, small_tables), str(tmp_path / "trips"), "csv")
    files.write_table(driver_tables.exported_weather(spark, small_tables), str(tmp_path / "weather"), "csv")
    prepared = preparation.prepare_files(spark, str(tmp_path / "trips"), str(tmp_path / "weather"), str(tmp_path / "out"))
    written = spark.read.json(str(tmp_path / "out" / "validation_report")).first().asDict()
    assert written == prepared.report.first().asDict() and written["status"] == "passed"
    assert spark.read.parquet(str(tmp_path / "out" / "processed")).count() == prepared.processed.count() > 0


def test_prepare_files_refuses_a_table_without_a_valid_row(spark, tmp_path):
    files.write_table(trip_table(spark, trip(vendor_id="8")), str(tmp_path / "trips"), "csv")
    with pytest.raises(InvalidTable, match="removed every row"):
        preparation.prepare_files(spark, str(tmp_path / "trips"), str(tmp_path / "none"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out" / "validation_report")).first()["status"] == "failed"


def test_exploratory_report_is_written(spark, small_tables, tmp_path):
    raw = driver_tables.text_trips(spark, small_tables)
    reports.write_exploratory_report(raw, str(tmp_path))
    shape = spark.read.option("header", True).csv(str(tmp_path / "shape")).first()
    assert int(shape["row_count"]) == raw.count()
    summary = spark.read.option("header", True).csv(str(tmp_path / "correlation_matrix"))
    assert summary.count() == len(summary.columns) - 1 > 5


def test_times_are_refused_in_another_zone(spark, tmp_path):
    files.write_table(trip_table(spark, trip()), str(tmp_path / "trips"), "csv")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(RuntimeError, match="UTC"):
            files.read_trips(spark, str(tmp_path / "trips"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_blocks_and_trees_of_files(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    bodies = {"empty.bin": b"", "one.bin": b"x" * 10, "long.bin": bytes(i % 251 for i in range(1_000))}
    for name, body in bodies.items():
        (folder / name).write_bytes(body)
    hashes = {Path(r["file"]).name: r for r in manifest.file_hashes(spark, str(folder), 64).collect()}
    assert {n: (r["bytes"], r["sha256"]) for n, r in hashes.items()} == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in bodies.items()}
    before = stored(manifest.block_hashes(spark, str(folder), 64), "blocks")
    rows = sorted((Path(r["file"]).name, r["block"], r["bytes"], r["sha256"]) for r in before.collect())
    want = [(n, i, len(b[i * 64 : i * 64 + 64]), hashlib.sha256(b[i * 64 : i * 64 + 64]).hexdigest()) for n, b in bodies.items() for i in range(max(1, -(-len(b) // 64)))]
    assert rows == sorted(want)

    def root(digests, fanout):
        while True:
            digests = [hashlib.sha256("".join(digests[i : i + fanout]).encode()).hexdigest() for i in range(0, len(digests), fanout)]
            if len(digests) == 1:
                return digests[0]

    trees = {Path(r["file"]).name: r["tree_sha256"] for r in manifest.file_trees(before, fanout=16).collect()}
    assert trees == {n: root([w[3] for w in want if w[0] == n], 16) for n in bodies}
    body = bytearray(bodies["long.bin"])
    body[700] ^= 1
    (folder / "long.bin").write_bytes(body + b"more" * 30)
    changed = manifest.changed_blocks(before, manifest.block_hashes(spark, str(folder), 64)).collect()
    assert sorted((Path(r["file"]).name, r["block"]) for r in changed) == [("long.bin", b) for b in (10, 15, 16, 17)]
