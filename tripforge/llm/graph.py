"""Connected components of links, by union-find within tasks and star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.session import Workspace

LINKS = "node long, peer long"


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task: each node under the smallest node that these links reach."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch["node"].to_pylist(), batch["peer"].to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for at in range(0, len(nodes), 100_000):
        some = nodes[at : at + 100_000]
        yield pa.RecordBatch.from_pydict({"node": pa.array(some, pa.int64()), "peer": pa.array([root(x) for x in some], pa.int64())})


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step. Every join is on one node, whose rows adaptive execution may split."""
    both = links.union(links.select(F.col("peer").alias("node"), F.col("node").alias("peer")))
    least = both.groupBy("node").agg(F.least(F.min("peer"), F.col("node")).alias("low"))
    wide = both.join(least, "node").where("peer > node").selectExpr("peer AS node", "low AS peer").distinct()
    low = wide.groupBy("node").agg(F.min("peer").alias("low"))
    moved = wide.join(low, "node").where("peer > low").selectExpr("peer AS node", "low AS peer")
    return moved.union(low.selectExpr("node", "low AS peer")).where("node > peer").distinct()


def components(links: DataFrame, work: Workspace, label: str) -> DataFrame:
    """``(node, root)`` for each node that has a link and isn't itself its component's smallest node.

    ``links`` has columns ``node`` and ``peer``. Links of a task shrink to a
    forest first; then stars are contracted until a round changes nothing, each
    round being stored, so that a lost executor costs one round at most.
    """
    links = links.where("node <> peer").selectExpr("greatest(node, peer) AS node", "least(node, peer) AS peer")
    current = work.store(links.repartition("node").mapInArrow(_forest, LINKS), f"{label}-0")
    size, turn = _state(current), 0
    while size[0]:
        turn += 1
        following = work.store(_stars(current), f"{label}-{turn}")
        work.drop(f"{label}-{turn - 1}")
        current, before, size = following, size, _state(following)
        if size == before:
            break
    return current.select("node", F.col("peer").alias("root"))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("node", "peer").cast("decimal(38,0)"))).first()
    return tuple(row)
