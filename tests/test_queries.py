"""Every registered query against its SQL, at the smallest scale."""

import compare
import pytest

import __spark_entry__ as entry
from tripforge.plans import oracle
from tripforge.plans.catalog import QUERIES

SQL = oracle.statements()
# Learned models and file hashes have no counterpart in SQL.
WITHOUT_SQL = {
    "boosted_trees_metrics",
    "dataset_blocks",
    "dataset_manifest",
    "linear_regression_metrics",
    "random_forest_metrics",
    "random_search_results",
    "scored_requests",
    "selected_model_importance",
}


@pytest.fixture(scope="module")
def con(small_tables):
    return compare.connect(small_tables)


def test_every_other_query_has_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result_as_sql(spark, con, small_tables, name):
    assert compare.difference(QUERIES[name](spark, small_tables), con, SQL[name]) is None


@pytest.mark.parametrize("name", ["linear_regression_metrics", "dataset_blocks", "dataset_manifest", "scored_requests"])
def test_others_give_rows(spark, small_tables, name):
    assert QUERIES[name](spark, small_tables).count() > 0


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["pickup_hour", "trips", "mean_km", "weather_share", "median_minutes"]
    assert df.count() == 24
