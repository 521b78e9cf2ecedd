import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plans import plan_text
from pyspark.sql import functions as F

from tripforge.operators import quantiles as Q

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
BY_RANK = {"max_values": 20, "cells": 7}


def hard_values(n=4000, seed=3):
    """A third of the rows share one value; the rest spread over many magnitudes."""
    rng = np.random.default_rng(seed)
    return np.where(rng.random(n) < 1 / 3, 5.0, np.exp(rng.normal(0, 6, n)) - 10)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    values = hard_values()
    pdf = pd.DataFrame({"x": values, "k": rng.integers(-3, 9, len(values)), "g": rng.choice(["a", "b"], len(values), p=[0.9, 0.1])})
    pdf.loc[:40, "x"] = np.nan
    pdf.loc[pdf.index % 50 == 0, "g"] = None
    return pdf, spark.createDataFrame(pdf).repartition(6).cache()


@pytest.mark.parametrize("options", [{}, BY_RANK])
def test_whole_columns(table, options):
    pdf, df = table
    found = Q.quantile_values(df, ["x", "k"], PROBS, **options)
    assert found["k"] == list(pdf["k"].quantile(PROBS))
    assert found["x"] == pytest.approx(list(pdf["x"].quantile(PROBS)), rel=1e-12)


@pytest.mark.parametrize("options", [{}, BY_RANK, {"max_values": 200, "cells": 9}, {"max_values": 1, "cells": 2}])
def test_groups_with_a_null_key(table, options):
    pdf, df = table
    rows = Q.quantiles(df, ["x"], [0.5, 0.9], by=["g"], **options).collect()
    assert len(rows) == 3
    for row in rows:
        mine = pdf[pdf["g"].isna()] if row["g"] is None else pdf[pdf["g"] == row["g"]]
        assert row["quantiles"] == pytest.approx(list(mine["x"].quantile([0.5, 0.9])), rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e9, 1e9) | st.sampled_from([0.0, 1.0, 1e-300, 1e300]), min_size=1, max_size=60))
def test_ranks_agree_with_sorting(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = Q.quantile_values(df, ["x"], [0.0, 0.5, 1.0], max_values=3, cells=4)["x"]
    assert found[0] == min(values) and found[2] == max(values)
    assert found[1] == pytest.approx(float(np.median(values)), rel=1e-12)


def test_infinities_and_empty_columns(spark):
    df = spark.createDataFrame([(math.inf, None), (-math.inf, None), (1.0, None), (2.0, None)], "x double, y double")
    for options in ({}, {"max_values": 1, "cells": 2}):
        found = Q.quantile_values(df, ["x", "y"], [0.0, 0.5, 1.0], **options)
        assert found["x"] == [-math.inf, 1.5, math.inf]
        assert found["y"] == [None, None, None]


def test_result_does_not_depend_on_partitions(table):
    _, df = table
    first = Q.quantile_values(df.repartition(1), ["x"], PROBS, **BY_RANK)
    assert first == Q.quantile_values(df.repartition(13), ["x"], PROBS, **BY_RANK)


def test_approximate_form(table):
    pdf, df = table
    found = Q.quantile_values(df, ["k"], [0.5], exact=False)["k"][0]
    assert found == pdf["k"].median()


@pytest.mark.parametrize("bound", [100_000, 0])
def test_many_groups_are_solved_together(spark, monkeypatch, bound):
    """One group holds a third of the rows, others few; brackets are broadcast or meet salted rows."""
    monkeypatch.setattr(Q, "BROADCAST_BRACKETS", bound)
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": np.where(rng.random(6_000) < 1 / 3, -1, rng.integers(0, 150, 6_000)), "x": np.round(rng.normal(0, 40, 6_000), 1)})
    pdf["y"] = pdf["x"].where(rng.random(6_000) < 0.9) * 1e9
    df = spark.createDataFrame(pdf).repartition(5)
    found = Q.quantiles(df, ["x", "y"], [0.0, 0.3, 0.5, 1.0], by=["g"], max_values=30, cells=8).collect()
    assert len(found) == 2 * pdf["g"].nunique()
    for row in found:
        mine = pdf[pdf["g"] == row["g"]][row["column"]].dropna()
        assert row["quantiles"] == pytest.approx(list(mine.quantile([0.0, 0.3, 0.5, 1.0])), rel=1e-12)


def test_no_task_gathers_a_group(spark, monkeypatch):
    """The passes over rows shuffle counts of cells: a group's rows never meet by the group's key alone."""
    rows = spark.range(50_000).select((F.col("id") % 3).alias("g"), F.rand(7).alias("x"))
    seen = []
    counted = Q._Search.inside
    monkeypatch.setattr(Q._Search, "inside", lambda self, *a: seen.append(counted(self, *a)) or seen[-1])
    monkeypatch.setattr(Q, "_counted", lambda *a: pytest.fail("values of a wide group were counted in one task"))
    assert Q.quantiles(rows, ["x"], [0.5], by=["g"], max_values=50, cells=64).count() == 3
    assert len(seen) >= 2
    for df in seen:
        assert "Exchange hashpartitioning" not in plan_text(df) and "BroadcastHashJoin" in plan_text(df)


@pytest.mark.parametrize("share", [500_000, 100])
def test_brackets_of_many_groups_do_not_pass_the_driver(spark, monkeypatch, share):
    """Beyond a few thousand groups no bracket is broadcast, and only large groups' brackets are copied for several tasks."""
    monkeypatch.setattr(Q, "ROWS_PER_SALT", share, raising=False)
    draw = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": np.concatenate([np.repeat(np.arange(12_000), 3), np.full(900, -1)])})
    pdf["x"] = np.round(draw.normal(0, 50, len(pdf)), 3)
    pdf.loc[pdf["g"] == 7, "x"] = 2.5
    df = spark.createDataFrame(pdf).withColumn("g", F.expr("nullif(g, 5)")).repartition(4)
    seen, first = [], Q._Search.inside
    monkeypatch.setattr(Q._Search, "inside", lambda self, b, n: seen.append((n, b, first(self, b, n))) or seen[-1][2])
    found = Q.quantiles(df, ["x"], [0.25, 0.5], by=["g"], max_values=1, cells=4).collect()
    mine = pdf.groupby("g")["x"].quantile([0.25, 0.5]).unstack()
    assert len(found) == 12_001
    for row in found:
        assert row["quantiles"] == pytest.approx(list(mine.loc[5 if row["g"] is None else row["g"]]), rel=1e-12)
    many = [(b, rows) for n, b, rows in seen if n > 10_000]
    assert many
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [plan_text(rows) for _, rows in many]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for (brackets, _), plan in zip(many, plans, strict=True):
        assert plan.count("BroadcastHashJoin") <= 1 and "SortMergeJoin" in plan  # the one is the list of large groups
        copies = brackets.agg(F.sum("salts"), F.max("salts")).first()
        assert copies[0] - brackets.count() < 100 and copies[1] == (9 if share == 100 else 1)
