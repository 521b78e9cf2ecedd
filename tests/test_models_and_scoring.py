import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripforge.operators import boosting, models, scoring
from tripforge.operators.features import TripPreprocessor
from tripforge.operators.sample import split_rows
from tripforge.plans import training
from tripforge.schema import CATEGORY_LEVELS, FEATURE_COLUMNS, NUMERIC_INPUTS, REQUEST_SCHEMA
from tripforge.streaming import scoring as streaming


@pytest.fixture(scope="module")
def trips(spark):
    rng = np.random.default_rng(6)
    n = 600
    pdf = pd.DataFrame({c: rng.integers(0, 10, n).astype(float) for c in NUMERIC_INPUTS})
    pdf["vendor_id"] = rng.choice([1, 2], n)
    pdf["store_and_fwd_flag"] = rng.choice(["N", "Y"], n)
    pdf["trip_duration"] = 100 + 120 * pdf["distance_km"] + 5 * pdf["pickup_hour"] + rng.normal(0, 1, n)
    pdf["id"] = [f"t{i}" for i in range(n)]
    return spark.createDataFrame(pdf).repartition(4).cache()


@pytest.fixture(scope="module")
def preprocessor(trips):
    return TripPreprocessor(passthroughCols=["id", "trip_duration"]).fit(trips)


@pytest.fixture(scope="module")
def features(trips, preprocessor):
    return preprocessor.transform(trips).cache()


@pytest.fixture(scope="module")
def runs(features):
    return training.train_all(
        features,
        forest={"numTrees": 8, "maxDepth": 6},
        boosted={"maxIter": 6, "maxDepth": 3},
        search=models.drawn_settings({"maxIter": [3], "maxDepth": [2, 4], "stepSize": [0.1, 0.3]}, draws=2),
        search_rows=200,
    )


def request(**changes):
    row = {
        "request_id": "r1",
        "passenger_count": 1.0,
        "distance_km": 7.4,
        "pickup_hour": 17,
        "pickup_day": 9,
        "pickup_month": 4,
        "pickup_weekday": 3,
        "rush_hour": 1,
        "is_weekend": 0,
        "temperature_c": None,
        "precipitation_mm": None,
        "wind_speed_kmh": None,
        "visibility_km": None,
        "vendor_id": 1,
        "store_and_fwd_flag": "N",
    }
    row.update(changes)
    return tuple(row[f.name] for f in REQUEST_SCHEMA)


def requests(spark, *rows):
    return spark.createDataFrame(list(rows), REQUEST_SCHEMA)


def test_four_models_are_compared(runs):
    table = models.comparison(runs).collect()
    assert len(table) == 4
    rmse = [r["RMSE"] for r in table]
    assert rmse == sorted(rmse)
    assert table[0]["Model"] == "Linear Regression"  # the target is linear
    assert table[0]["R2"] > 0.99


def test_selection_and_export(spark, features, runs, tmp_path):
    selection = training.select_best(features, runs, top=7)
    assert selection.importance is None  # a linear model has none
    assert selection.errors.count() == 7
    training.export_selection(selection, str(tmp_path))
    again = models.load_run(spark, f"{tmp_path}/best_run")
    assert again.name == "Linear Regression"
    assert again.metrics.first() == selection.best.metrics.first()
    assert spark.read.parquet(f"{tmp_path}/model_comparison").count() == 4


def test_importance_of_trees(spark, runs):
    rows = models.feature_importance(spark, runs[1].model).collect()
    assert [r["Feature"] for r in rows][0] == "num__distance_km"
    assert sum(r["Importance"] for r in rows) == pytest.approx(1.0)
    assert len(rows) == len(FEATURE_COLUMNS)


def test_absent_run(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="train it first"):
        models.load_run(spark, str(tmp_path / "nothing"))


def test_drawn_settings_are_distinct_and_repeatable():
    first = models.drawn_settings()
    assert first == models.drawn_settings() and len(first) == 10
    assert len({str(s) for s in first}) == 10
    assert all(value in models.SEARCH_SPACE[name] for s in first for name, value in s.items())
    assert len(models.drawn_settings({"maxIter": [1, 2]}, draws=10)) == 2


def test_search_returns_the_lowest_rmse(spark, features, tmp_path):
    settings = [{"maxIter": 1, "maxDepth": 1}, {"maxIter": 8, "maxDepth": 4}]
    train, _ = split_rows(features, "id")
    best, found = models.random_search(train, settings, rows=300)
    assert best == settings[1]
    table = models.search_table(spark, settings, found).collect()
    assert table[0]["mean_rmse"] < table[1]["mean_rmse"] and "'maxIter', 8" in table[0]["settings"]
    rows = found.collect()
    assert sorted((r["setting"], r["fold"]) for r in rows) == [(s, f) for s in range(2) for f in range(3)]
    assert all(r["trained_rows"] + r["validated_rows"] == 300 for r in rows)
    models.save_search(settings, found, str(tmp_path / "search"))
    again, loaded = models.load_search(spark, str(tmp_path / "search"))
    assert again == settings and sorted(loaded.collect()) == sorted(rows)
    # Partitions do not change a search.
    assert sorted(models.random_search(train.repartition(9), settings, rows=300)[1].collect()) == sorted(rows)


def slow_tree(bins, goal, bag, depth, least):
    """The same tree node by node, every split tried."""
    predicted = np.zeros(len(goal))

    def grow(rows, inside, left):
        mean = goal[inside].mean()
        predicted[rows] = mean
        best = (1e-12, None)
        for f in range(bins.shape[1]) if left else ():
            for edge in range(boosting.BINS - 1):
                low = inside[bins[inside, f] <= edge]
                high = inside[bins[inside, f] > edge]
                if min(len(low), len(high)) >= least:
                    gain = goal[low].sum() ** 2 / len(low) + goal[high].sum() ** 2 / len(high) - goal[inside].sum() ** 2 / len(inside)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, edge))
        if best[1]:
            f, edge = best[1]
            for side in (bins[:, f] <= edge, bins[:, f] > edge):
                grow(rows[side[rows]], inside[side[inside]], left - 1)

    grow(np.arange(len(goal)), np.flatnonzero(bag), depth)
    return predicted


def test_trees_match_a_search_of_every_split():
    draw = np.random.default_rng(3)
    for least in (1, 4):
        bins = draw.integers(0, 12, (150, 4)).astype(np.int8)
        goal, bag = draw.normal(size=150) + bins[:, 1] * (bins[:, 2] > 5), draw.random(150) < 0.8
        assert boosting.tree(bins, goal, bag, 4, least, 1.0, draw) == pytest.approx(slow_tree(bins, goal, bag, 4, least))


def test_boosting_agrees_with_the_distributed_trees(spark):
    """The same loss, steps and splits: both leave about the same error on unseen rows."""
    draw = np.random.default_rng(9)
    pdf = pd.DataFrame(draw.normal(size=(1_500, 3)), columns=["a", "b", "c"])
    pdf["y"] = pdf["a"] * pdf["b"] + np.sin(3 * pdf["c"]) + draw.normal(0, 0.1, 1_500)
    pdf["id"] = [str(i) for i in range(1_500)]
    df = spark.createDataFrame(pdf)
    setting = {"maxIter": 25, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "1.0", "minInstancesPerNode": 3}
    found = boosting.search(df, [setting], ["a", "b", "c"], "y", "id", 5_000, 3, 42).collect()
    ours = np.mean([r["rmse"] for r in found])
    fold = boosting.fold_of("id", 42, 3)
    run = models.run_model(
        "x", models.boosted_trees("y", **{**setting, "featureSubsetStrategy": "all"}), df.filter(fold != 0), df.filter(fold == 0), "y", features=["a", "b", "c"]
    )
    assert run.metrics.first()["RMSE"] == pytest.approx(ours, rel=0.12)


def test_default_settings():
    forest, trees = models.random_forest(), models.boosted_trees()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode()) == (150, 20, 2)
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize()) == (300, 8, 0.08)


@pytest.mark.parametrize(
    ("changes", "field"),
    [
        ({"vendor_id": 3}, "vendor_id"),
        ({"passenger_count": 9.0}, "passenger_count"),
        ({"distance_km": 0.0}, "distance_km"),
        ({"distance_km": 200.1}, "distance_km"),
        ({"pickup_hour": 24}, "pickup_hour"),
        ({"pickup_day": 0}, "pickup_day"),
        ({"pickup_month": 13}, "pickup_month"),
        ({"pickup_weekday": None}, "pickup_weekday"),
        ({"store_and_fwd_flag": "n"}, "store_and_fwd_flag"),
        ({"wind_speed_kmh": -0.1}, "wind_speed_kmh"),
    ],
)
def test_request_rules(spark, changes, field):
    row = scoring.checked_requests(requests(spark, request(**changes))).first()
    assert row["_errors"] == [field]


def test_limits_of_a_request_are_accepted(spark):
    rows = [request(), request(distance_km=200.0, pickup_hour=0, passenger_count=8.0, temperature_c=-40.0)]
    checked = scoring.checked_requests(requests(spark, *rows))
    assert scoring.accepted(checked).count() == 2
    assert scoring.rejected(checked).count() == 0


def test_request_features(spark):
    row = scoring.with_indicators(scoring.request_inputs(requests(spark, request(visibility_km=1.0)))).first()
    assert (row["rush_hour"], row["is_weekend"], row["weather_data_available"]) == (1, 0, 1)
    assert (row["cat__vendor_id_1"], row["cat__vendor_id_2"]) == (1, 0)
    assert (row["cat__store_and_fwd_flag_N"], row["cat__store_and_fwd_flag_Y"]) == (1, 0)


class FixedModel:
    """Predicts 750 seconds and looks at the columns it is given."""

    def transform(self, df):
        assert set(NUMERIC_INPUTS) | set(CATEGORY_LEVELS) <= set(df.columns)
        return df.withColumn("prediction", F.lit(750.0))


def test_seconds_and_minutes(spark):
    row = scoring.score_requests(requests(spark, request()), FixedModel()).first()
    assert row.asDict() == {"request_id": "r1", "trip_duration_seconds": 750.0, "trip_duration_minutes": 12.5}


def test_batch_and_stream_agree(spark, preprocessor, runs, tmp_path):
    model = training.scoring_model(preprocessor, runs[0])
    rows = requests(spark, *[request(request_id=f"r{i}", distance_km=1.0 + i, temperature_c=float(i)) for i in range(20)], request(request_id="bad", vendor_id=5))
    rows.repartition(3).write.json(str(tmp_path / "in"))
    batch = {r["request_id"]: r["trip_duration_seconds"] for r in scoring.score_requests(rows, model).collect()}
    source = streaming.request_stream(spark, str(tmp_path / "in"))
    streaming.score_stream(source, model, str(tmp_path / "out"), str(tmp_path / "c1"), once=True).awaitTermination(120)
    streaming.reject_stream(source, str(tmp_path / "bad"), str(tmp_path / "c2"), once=True).awaitTermination(120)
    stream = {r["request_id"]: r["trip_duration_seconds"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(batch) == 20 and stream == pytest.approx(batch)
    assert spark.read.parquet(str(tmp_path / "bad")).first()["_errors"] == ["vendor_id"]


def test_nan_weather_counts_as_missing(spark):
    measures = ("temperature_c", "precipitation_mm", "wind_speed_kmh", "visibility_km")
    checked = scoring.checked_requests(requests(spark, request(**dict.fromkeys(measures, float("nan")))))
    row = scoring.request_inputs(scoring.accepted(checked)).first()
    assert row["weather_data_available"] == 0 and [row[c] for c in measures] == [None] * 4


def test_boosted_trees_of_a_bounded_table_are_one_chain(spark, monkeypatch, tmp_path):
    """No job for every level of every tree; the engine's own model, as good as its own fit, whatever the partitions."""
    draw = np.random.default_rng(4)
    pdf = pd.DataFrame(draw.normal(size=(1_500, 3)), columns=["a", "b", "c"])
    pdf["y"] = pdf["a"] + np.sin(3 * pdf["c"]) + draw.normal(0, 0.3, 1_500)
    pdf["id"] = [str(i) for i in range(1_500)]
    pdf.loc[:9, "id"] = None
    df = spark.createDataFrame(pdf).repartition(5)
    train, test = df.filter("abs(hash(y)) % 4 > 0"), df.filter("abs(hash(y)) % 4 = 0")
    monkeypatch.setattr(models, "CHAIN_LEVELS", 100, raising=False)
    trees = models.boosted_trees("y", maxIter=30, maxDepth=4, stepSize=0.1, featureSubsetStrategy="all", minInstancesPerNode=3)
    spark.sparkContext.setJobGroup("chain", "chain")
    try:
        run = models.run_model("x", trees, train, test, "y", features=["a", "b", "c"])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain")) < 60
    fitted = run.model.stages[-1]
    assert (fitted.getNumTrees, fitted.treeWeights[:2], fitted.getMaxDepth()) == (30, [1.0, 0.1], 4)
    assert sum(fitted.featureImportances.toArray()) == pytest.approx(1.0)
    assert all(tree.depth <= 4 for tree in fitted.trees)
    models.save_run(run, str(tmp_path / "run"))
    again = models.load_run(spark, str(tmp_path / "run"))
    rows = lambda model: sorted(r["prediction"] for r in model.transform(test).collect())
    assert rows(again.model) == rows(run.model)
    other = models.run_model("x", trees, train.repartition(2), test, "y", features=["a", "b", "c"])
    assert rows(other.model) == pytest.approx(rows(run.model))
    # What the model predicts is what the chain predicts for its rows.
    kept, edges = [], boosting.bin_edges(train, ["a", "b", "c"])
    table = boosting.binned(train.withColumn("place", boosting.row_hash("id", 42)), ["a", "b", "c"], edges=edges).toPandas().sort_values(["place", "y"])
    setting = {"maxIter": 30, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "1.0", "minInstancesPerNode": 3}
    ours = boosting.ensemble(np.stack(table["bins"]), table["y"].to_numpy(), np.ones(len(table), bool), setting, np.random.default_rng(42), kept)
    assert sorted(ours) == pytest.approx(sorted(r["prediction"] for r in run.model.transform(train).collect()))
    assert sum(len(nodes["count"]) for nodes in kept) == fitted.totalNumNodes
    monkeypatch.setattr(models, "CHAIN_ROWS", 0)
    engine = models.run_model("x", trees, train, test, "y", features=["a", "b", "c"])
    assert run.metrics.first()["RMSE"] == pytest.approx(engine.metrics.first()["RMSE"], rel=0.12)
    with pytest.raises(Exception, match="(?i)missing|null"):
        monkeypatch.setattr(models, "CHAIN_ROWS", 5_000)
        models.run_model("x", trees, train.withColumn("y", F.expr("nullif(y, y)")), test, "y", features=["a", "b", "c"])
