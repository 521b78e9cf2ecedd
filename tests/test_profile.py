from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripforge.operators import frequent, profile


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    n = 400
    pdf = pd.DataFrame(
        {
            "passenger_count": rng.integers(1, 7, n).astype(float),
            "pickup_longitude": rng.normal(-73.9, 0.03, n),
            "pickup_hour": rng.integers(0, 24, n),
            "trip_duration": rng.lognormal(6, 1, n).round(),
            "constant": 0.1,
            "flag": rng.choice(["N", "Y"], n, p=[0.9, 0.1]),
        }
    )
    pdf.loc[::7, "passenger_count"] = np.nan
    pdf.loc[::11, "flag"] = None
    return pdf, spark.createDataFrame(pdf).repartition(5).cache()


def test_describe_matches_pandas(table):
    pdf, df = table
    found = {r["column"]: r for r in profile.describe(df).collect()}
    expected = pdf.drop(columns="flag").describe().T
    assert set(found) == set(expected.index)
    for column, row in expected.iterrows():
        mine = found[column]
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert mine[ours] == pytest.approx(row[theirs], rel=1e-9, abs=1e-12)


def test_missing_summary(table):
    pdf, df = table
    found = {r["column"]: (r["missing_count"], r["missing_percentage"]) for r in profile.missing_summary(df).collect()}
    count = pdf.isnull().sum()
    share = (count / len(pdf) * 100).round(2)
    assert found == {c: (count[c], share[c]) for c in pdf.columns}
    assert [r["column"] for r in profile.missing_columns(df).collect()] == list(
        share[share > 0].sort_values(ascending=False).index
    )


def test_missing_summary_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert [tuple(r) for r in profile.missing_summary(df).collect()] == [("a", 0, None), ("b", 0, None)]


def test_value_counts_keep_missing_values_and_break_ties(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "v string")
    rows = profile.value_counts(df, top=3).orderBy("rank").collect()
    assert [(r["value"], r["n"]) for r in rows] == [(None, 3), ("b", 2), ("a", 1)]


def test_correlations_match_pandas(table):
    pdf, df = table
    columns = ["passenger_count", "pickup_longitude", "pickup_hour", "trip_duration", "constant", "absent"]
    rows = {r["column"]: r for r in profile.correlation_matrix(df, columns).collect()}
    expected = pdf[columns[:-1]].corr()
    for a in expected.index:
        for b in expected.columns:
            want = expected.loc[a, b]
            if "constant" in (a, b):
                assert rows[a][b] is None
            else:
                assert rows[a][b] == pytest.approx(want, abs=1e-10)


def test_correlation_skips_empty_columns_and_needs_two(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 1.0, None)], "a double, b double, c double")
    assert profile.correlation_matrix(df, ["a", "b", "c"]).columns == ["column", "a", "b"]
    with pytest.raises(ValueError, match="two columns"):
        profile.correlation_matrix(df, ["a", "c"])


def test_histogram_matches_numpy(table):
    pdf, df = table
    found = profile.histogram(df, "trip_duration", bins=50).orderBy("bin").collect()
    shown = pdf["trip_duration"][pdf["trip_duration"] <= pdf["trip_duration"].quantile(0.99)]
    counts, edges = np.histogram(shown, bins=50)
    assert [r["trips"] for r in found] == list(counts)
    assert [r["bin_start"] for r in found] == pytest.approx(list(edges[:-1]))
    assert sum(r["trips"] for r in found) == len(shown)


def test_histogram_of_one_value(spark):
    rows = profile.histogram(spark.createDataFrame([(3.0,)] * 4, "x double"), "x", bins=4).orderBy("bin").collect()
    assert [r["trips"] for r in rows] == [0, 0, 4, 0]
    with pytest.raises(ValueError, match="no value"):
        profile.histogram(spark.createDataFrame([(None,)], "x double"), "x")


def test_medians_and_rush_summary(table):
    pdf, df = table
    medians = {r[0]: r[1] for r in profile.median_minutes_by_hour(df).collect()}
    expected = (pdf.groupby("pickup_hour")["trip_duration"].median() / 60).to_dict()
    assert medians == pytest.approx(expected)
    rush = pdf["pickup_hour"].between(7, 10) | pdf["pickup_hour"].between(16, 20)
    summary = pdf.groupby(rush.astype(int))["trip_duration"].agg(["count", "mean", "median"])
    for row in profile.rush_hour_summary(df).collect():
        want = summary.loc[row["rush_hour"]]
        assert row["trips"] == want["count"]
        assert (row["mean_minutes"], row["median_minutes"]) == pytest.approx((want["mean"] / 60, want["median"] / 60))


def test_counts_and_shape(table):
    pdf, df = table
    counts = {r[0]: r[1] for r in profile.counts_by(df, "pickup_hour").collect()}
    assert counts == pdf["pickup_hour"].value_counts().to_dict()
    assert tuple(profile.row_and_column_count(df).first()) == (400, 6)
    assert profile.first_rows(df).count() == 5
    assert profile.text_columns(df) == ["flag"]
    assert dict(profile.column_types(df))["flag"] == "string"


def test_histogram_refuses_infinite_values(spark):
    df = spark.createDataFrame([(float("-inf"),), (1.0,), (2.0,)], "x double")
    with pytest.raises(ValueError, match="infinite"):
        profile.histogram(df, "x")


@pytest.mark.parametrize("buckets", [1 << 16, 16, 1])
@pytest.mark.parametrize("top", [3, 40, 5_000])
def test_frequent_values_of_any_number(spark, buckets, top):
    """Skewed, flat and constant columns, with ties at the end of the list and missing values."""
    rows = [(f"w{int(3_000 / (i + 1))}" if i % 9 else None, f"u{i}", "same") for i in range(3_000)]
    df = spark.createDataFrame(rows, "skewed string, flat string, constant string").repartition(5)
    tall = df.select(F.expr("stack(3, 'skewed', skewed, 'flat', flat, 'constant', constant) AS (column, value)"))
    found = {}
    for r in frequent.frequent_values(tall, top, buckets).collect():
        found.setdefault(r["column"], []).append((r["rank"], r["value"], r["n"]))
    for place, column in enumerate(["skewed", "flat", "constant"]):
        counts = Counter(r[place] for r in rows)
        order = sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:top]
        assert sorted(found[column]) == [(i + 1, v, n) for i, (v, n) in enumerate(order)]
    assert frequent.frequent_values(tall.filter("false"), top).collect() == []


def test_long_value_counts_agree_with_short_ones(spark, monkeypatch):
    df = spark.range(4_000).select(F.expr("CAST(sqrt(id) AS INT)").cast("string").alias("v"))
    short = profile.value_counts(df, top=50).collect()
    monkeypatch.setattr(profile, "SHORT_LIST", 10)
    assert sorted(map(tuple, profile.value_counts(df, top=50).collect())) == sorted(map(tuple, short))


def test_correlations_keep_digits_beside_large_means(spark):
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({"a": 1e9 + rng.normal(0, 1, 800), "b": rng.normal(0, 1, 800)})
    pdf["c"] = pdf["a"] - 1e9 + pdf["b"]
    pdf.loc[::7, "b"] = np.nan
    df = spark.createDataFrame(pdf).repartition(6)
    found = {r["column"]: r.asDict() for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    want = pdf.corr()
    for x in "abc":
        for y in "abc":
            assert found[x][y] == pytest.approx(want[x][y], abs=1e-7)
