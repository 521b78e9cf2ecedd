import hashlib

import pytest
from plans import plan_text
from pyspark.sql import functions as F

from tripforge.operators import ranking, sample


def digest(i, seed=42):
    return hashlib.md5(f"{i}|{seed}".encode()).hexdigest()


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(3000).select(F.col("id").cast("string").alias("id")).repartition(7).cache()


@pytest.mark.parametrize("sortable", [sample.SORTABLE, 2])
@pytest.mark.parametrize("n", [1, 17, 2999])
def test_sample_is_the_smallest_hashes(ids, monkeypatch, sortable, n):
    monkeypatch.setattr(sample, "SORTABLE", sortable)
    found = {r["id"] for r in sample.sample_rows(ids, "id", n).collect()}
    assert found == {str(i) for i in sorted(range(3000), key=digest)[:n]}


def test_sample_larger_than_the_table(ids):
    assert sample.sample_rows(ids, "id", 5000).count() == 3000


def test_sample_size_is_exact_with_repeated_keys(spark):
    df = spark.createDataFrame([("a", i) for i in range(40)] + [("b", i) for i in range(40)], "id string, v int")
    for n in (1, 39, 45):
        assert sample.sample_rows(df, "id", n).count() == n


def test_split_is_disjoint_exhaustive_and_stable(ids):
    train, test = sample.split_rows(ids, "id")
    left, right = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
    assert not left & right and len(left | right) == 3000
    assert 0.17 < len(right) / 3000 < 0.23
    again = sample.split_rows(ids.repartition(3), "id")[1]
    assert right == {r["id"] for r in again.collect()}
    assert right == {str(i) for i in range(3000) if digest(i)[:8] < "33333333"}


def test_exact_split(ids):
    train, test = sample.split_rows(ids, "id", share=0.1501, exact=True)
    assert (train.count(), test.count()) == (2549, 451)


@pytest.mark.parametrize("prune", [True, False])
def test_top_rows(spark, prune):
    df = spark.range(2000).select("id", F.pmod(F.col("id") * 7919, F.lit(977)).cast("double").alias("v")).repartition(9)
    rows = [(r["id"], r["v"]) for r in ranking.top_rows(df, "v", 30, "id", prune).collect()]
    expected = sorted(((i, float(i * 7919 % 977)) for i in range(2000)), key=lambda p: (-p[1], p[0]))[:30]
    assert rows == expected


def test_top_rows_when_all_are_equal_or_few(spark):
    df = spark.range(500).select("id", F.lit(1.0).alias("v"))
    assert [r["id"] for r in ranking.top_rows(df, "v", 10, "id", True).collect()] == list(range(10))
    assert ranking.top_rows(df.limit(4), "v", 10, "id", True).count() == 4


def test_samples_of_parts_merge(ids):
    parts = [sample.sample_rows(ids.filter(F.col("id").cast("int") % 3 == i), "id", 40) for i in range(3)]
    merged = {r["id"] for r in sample.merged_sample(parts, "id", 40).collect()}
    assert merged == {r["id"] for r in sample.sample_rows(ids, "id", 40).collect()}


def test_sample_does_not_sort(ids):
    plan = plan_text(sample.sample_rows(ids, "id", 500))
    assert "Sort" not in plan and "TakeOrdered" not in plan and "Exchange" not in plan.split("InMemoryRelation")[0]


def test_numbers_are_gapless_and_follow_the_order(spark):
    rows = [(i * 7919 % 1009, None if i % 5 == 0 else f"g{i % 3}") for i in range(1009)]
    df = spark.createDataFrame(rows, "v int, g string").repartition(6)
    alone = {r["v"]: r["number"] for r in ranking.numbered(df, ["v"]).collect()}
    assert alone == {v: v + 1 for v in range(1009)}
    within = {}
    for r in ranking.numbered(df, [F.desc("v")], ["g"], "rank", first=0).collect():
        within.setdefault(r["g"], []).append((r["rank"], r["v"]))
    assert set(within) == {None, "g0", "g1", "g2"}
    for found in within.values():
        assert [n for n, _ in sorted(found)] == list(range(len(found)))
        assert [v for _, v in sorted(found)] == sorted((v for _, v in found), reverse=True)
    assert ranking.numbered(df.filter("v < 0"), ["v"]).collect() == []


def test_numbers_need_no_task_with_all_rows(spark):
    df = spark.range(5_000).select(F.col("id").alias("v")).repartition(4)
    plan = plan_text(ranking.numbered(df, ["v"]))
    assert "SinglePartition" not in plan
