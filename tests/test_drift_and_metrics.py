import math

import numpy as np
import pandas as pd
import pytest
from plans import plan_text

from tripforge.operators import drift, metrics
from tripforge.plans import reports


def numpy_psi(reference, current, bins=10):
    edges = sorted(set(np.quantile(reference, [i / bins for i in range(bins + 1)])))
    if len(edges) < 2:
        return 0.0
    inner = edges[1:-1]
    e = np.bincount(np.searchsorted(inner, reference, side="right"), minlength=len(edges) - 1) / len(reference)
    a = np.bincount(np.searchsorted(inner, current, side="right"), minlength=len(edges) - 1) / len(current)
    e, a = np.maximum(e, 1e-6), np.maximum(a, 1e-6)
    return float(((a - e) * np.log(a / e)).sum())


def one_column(spark, values):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")


def psi_value(spark, reference, current):
    return drift.psi(one_column(spark, reference), one_column(spark, current), ["x"]).first()["psi"]


def test_psi_of_equal_and_shifted_distributions(spark):
    values = np.arange(100.0)
    assert psi_value(spark, values, values) == 0.0
    shifted = psi_value(spark, values, values + 50)
    assert shifted > 0.20
    assert shifted == pytest.approx(6.6523, abs=1e-4)


def test_psi_matches_numpy_with_ties_and_is_never_negative(spark):
    rng = np.random.default_rng(2)
    for reference, current in (
        (rng.integers(0, 5, 300), rng.integers(1, 7, 200)),
        (rng.normal(0, 1, 500), rng.normal(0.2, 1.5, 400)),
    ):
        found = psi_value(spark, reference, current)
        assert found >= 0
        assert found == pytest.approx(numpy_psi(reference, current))


def test_psi_edge_cases(spark):
    assert psi_value(spark, [3.0] * 10, [4.0] * 10) == 0.0
    assert psi_value(spark, [None, math.nan], [1.0]) == 0.0
    assert psi_value(spark, [1.0, 2.0, 3.0], [None, math.inf]) == 0.0
    assert psi_value(spark, [1.0, 2.0, math.inf, math.nan], [1.0, 2.0]) == pytest.approx(0.0)


def test_drift_metrics_and_report(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"num__distance_km": rng.normal(0, 1, 600), "num__pickup_hour": rng.normal(0, 1, 600)})
    reference = spark.createDataFrame(pdf)
    current = reference.selectExpr("num__distance_km + 2 AS num__distance_km", "num__pickup_hour")
    rows = {r["feature"]: r for r in drift.drift_metrics(reference, current).collect()}
    assert list(rows) == ["num__distance_km", "num__pickup_hour"] or set(rows) == {"num__distance_km", "num__pickup_hour"}
    moved = rows["num__distance_km"]
    assert moved["drift_detected"] and not rows["num__pickup_hour"]["drift_detected"]
    mean = pdf["num__distance_km"].mean()
    assert moved["relative_mean_shift"] == pytest.approx(2 / max(abs(mean), 1e-6))
    report = drift.drift_report(drift.drift_metrics(reference, current)).first()
    assert report["drifted_features"] == ["num__distance_km"]
    assert report["retraining_triggered"] is True


def test_no_watched_feature(spark):
    with pytest.raises(ValueError, match="watched"):
        drift.watched_features(one_column(spark, [1.0]))
    assert drift.watched_features(spark.createDataFrame([(1, 2)], "num__pickup_hour int, num__distance_km int")) == [
        "num__distance_km",
        "num__pickup_hour",
    ]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "id string, actual double, predicted double")


def test_metrics(spark):
    df = pairs(spark, [("a", 1.0, 2.0), ("b", 2.0, 2.0), ("c", 6.0, 3.0)])
    row = metrics.regression_metrics(df).first()
    assert row["MAE"] == pytest.approx(4 / 3)
    assert row["RMSE"] == pytest.approx(math.sqrt(10 / 3))
    assert row["R2"] == pytest.approx(1 - 10 / 14)


def test_r2_of_a_constant_target(spark):
    assert metrics.regression_metrics(pairs(spark, [("a", 2.0, 2.0), ("b", 2.0, 2.0)])).first()["R2"] == 1.0
    assert metrics.regression_metrics(pairs(spark, [("a", 2.0, 1.0), ("b", 2.0, 2.0)])).first()["R2"] == 0.0


def test_comparison_and_best(spark):
    good = metrics.regression_metrics(pairs(spark, [("a", 1.0, 1.1), ("b", 2.0, 2.1)]))
    poor = metrics.regression_metrics(pairs(spark, [("a", 1.0, 5.0), ("b", 2.0, 2.0)]))
    table = metrics.compare_models([("poor", poor), ("good", good)])
    assert [r["Model"] for r in table.collect()] == ["good", "poor"]
    assert metrics.best_model(table).first()["Model"] == "good"


def test_metrics_by_model(spark):
    df = pairs(spark, [("a", 1.0, 2.0), ("b", 3.0, 3.0)]).selectExpr("*", "'m' AS Model")
    assert metrics.metrics_by_model(df).first()["MAE"] == 0.5


def test_errors(spark):
    df = pairs(spark, [("a", 1.0, 2.0), ("b", 9.0, 3.0), ("c", 5.0, 4.0)])
    rows = metrics.largest_errors(df, 2).collect()
    assert [(r["id"], r["error"], r["absolute_error"]) for r in rows] == [("b", 6.0, 6.0), ("a", -1.0, 1.0)]
    summary = metrics.error_summary(df).first()
    assert (summary["count"], summary["mean"], summary["q50"]) == (3, 2.0, 1.0)


def test_alignment_is_by_key(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "id string, actual double")
    right = spark.createDataFrame([("b", 20.0), ("a", 10.0)], "id string, predicted double")
    assert {r["id"]: r["predicted"] for r in metrics.aligned(left, right).collect()} == {"a": 10.0, "b": 20.0}


def test_largest_errors_meet_their_features_without_a_shuffle_of_these(spark, tmp_path):
    predictions = pairs(spark, [("a", 1.0, 2.0), ("b", 9.0, 3.0), ("c", 5.0, 4.0)])
    spark.createDataFrame([("a", 10), ("b", 20), ("c", 30)], "id string, x int").write.parquet(str(tmp_path / "f"))
    features = spark.read.parquet(str(tmp_path / "f"))
    found = metrics.largest_errors_with_features(features, predictions, 2)
    assert [(r["id"], r["x"], r["absolute_error"]) for r in found.collect()] == [("b", 20, 6.0), ("a", 10, 1.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(id" not in plan


def test_largest_errors_refuse_repeated_keys(spark):
    predictions = pairs(spark, [("a", 1.0, 2.0), ("a", 9.0, 3.0)])
    features = spark.createDataFrame([("a", 10), ("a", 20)], "id string, x int")
    with pytest.raises(ValueError, match="share a value of id"):
        metrics.largest_errors_with_features(features, predictions)


def test_a_stored_profile_stands_for_its_reference(spark, tmp_path):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"x": rng.normal(3, 1, 900), "y": rng.integers(0, 4, 900).astype(float), "day": rng.integers(0, 3, 900)})
    pdf.loc[::50, "x"] = np.nan
    reference = spark.createDataFrame(pdf)
    drift.reference_profile(reference, ["x", "y"]).write.parquet(str(tmp_path / "profile"))
    stored = spark.read.parquet(str(tmp_path / "profile"))
    found = {(r["day"], r["feature"]): r for r in drift.compared(stored, reference, ["day"]).collect()}
    assert len(found) == 6
    for day in range(3):
        alone = drift.drift_metrics(reference, reference.filter(f"day = {day}"), ["x", "y"]).collect()
        for r in alone:
            assert tuple(found[day, r["feature"]])[2:] == pytest.approx(tuple(r)[1:], rel=1e-9)
    plan = plan_text(drift.compared(stored, reference, ["day"]))
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") + plan.count("InMemoryTableScan") == 1


def test_profiles_merge(spark):
    rng = np.random.default_rng(7)
    df = spark.createDataFrame(pd.DataFrame({"x": rng.normal(0, 1, 400), "y": np.arange(400.0)}))
    whole = drift.reference_profile(df, ["x", "y"])
    parts = [drift.profile_of(df.filter(c), whole) for c in ("y < 130", "y >= 130")]
    merged = {r["feature"]: r for r in drift.merged_profiles(*parts).collect()}
    for r in whole.collect():
        assert merged[r["feature"]]["counts"] == r["counts"] and merged[r["feature"]]["present"] == r["present"]
        assert merged[r["feature"]]["total"] == pytest.approx(r["total"])
    with pytest.raises(ValueError, match="same features and edges"):
        drift.merged_profiles(whole, drift.reference_profile(df.filter("y < 50"), ["x", "y"]))


def test_report_names_what_was_compared(spark):
    df = spark.range(300).selectExpr("CAST(id AS STRING) AS id", "CAST(id AS DOUBLE) AS num__distance_km")
    report, _ = reports.drift_tables(df, df, "id", 100, 7, input="trips")
    row = report.first()
    assert (row["input"], row["seed"], row["sample_size"]) == ("trips", 7, 100)
    assert reports.drift_tables(df, df)[0].first()["seed"] is None
