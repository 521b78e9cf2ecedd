"""Shards by descent through a weighted hash tree of regions, racks and shards, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS_PER_RACK, RACKS_PER_REGION = 2, 2
#: Positions within a shard are counted per bucket of this many hex digits of a hash, so no task sees a whole shard.
SLOT_DIGITS = 3

_BITS = 52


@dataclass(frozen=True)
class Leaf:
    """A shard and its place. Weights of racks and regions are sums over their shards."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0


def balanced_tree(shards: int = 8) -> list[Leaf]:
    """Equal shards, two to a rack and two racks to a region."""
    per_region = SHARDS_PER_RACK * RACKS_PER_REGION
    return [Leaf(f"r{i // per_region}", f"r{i // per_region}/k{i // SHARDS_PER_RACK}", i) for i in range(shards)]


def grown(tree: list[Leaf]) -> list[Leaf]:
    """One more shard as a region of its own: no weight inside the old regions changes, so rows move into it only."""
    new = max(leaf.shard for leaf in tree) + 1
    return [*tree, Leaf(f"r+{new}", f"r+{new}/k+{new}", new, sum(x.weight for x in tree) / len(tree))]


def children(tree: list[Leaf]) -> dict[str, dict[str, float]]:
    """For each inner node, its children and their weights."""
    down: dict[str, dict[str, float]] = {}
    for leaf in tree:
        for parent, child in (("", leaf.region), (leaf.region, leaf.rack), (leaf.rack, str(leaf.shard))):
            own = down.setdefault(parent, {})
            own[child] = own.get(child, 0.0) + leaf.weight
    return down


def descend(key: Column, tree: list[Leaf]) -> Column:
    """The shard of a key.

    At each level every child draws ``-ln(u) / weight`` with ``u`` hashed from
    key and child; the least draw wins, in proportion to the weights. A changed
    weight alters that child's draws alone: keys leave or enter it, and no key
    moves between its siblings or inside their subtrees.
    """
    down = children(tree)
    table = F.create_map(
        *[
            part
            for parent, own in down.items()
            for part in (
                F.lit(parent),
                F.array(*[F.struct(F.lit(name).alias("name"), F.lit(weight).alias("weight")) for name, weight in own.items()]),
            )
        ]
    )

    def pick(parent: Column) -> Column:
        def draw(child: Column) -> Column:
            digits = F.substring(F.md5(F.concat(key, F.lit("/"), child["name"])), 1, _BITS // 4)
            u = (F.conv(digits, 16, 10).cast("double") + 1) / F.lit(float(1 << _BITS) + 1)
            return F.struct((-F.log(u) / child["weight"]).alias("score"), child["name"].alias("name"))

        return F.array_min(F.transform(F.element_at(table, parent), draw))["name"]

    return pick(pick(pick(F.lit("")))).cast("int")


def sharded(docs: DataFrame, tree: list[Leaf] | None = None) -> DataFrame:
    """One row per document: size, checksum, shard, gapless slot in the shard, and the shard after growth by one.

    The id alone decides the shard, so equal ids and repeated rows share one; a
    null id counts as the empty key. Size is the text's UTF-8 bytes plus one, a
    null text having none. Slots follow a hash of the id: counts per shard and
    hash bucket give each bucket its first slot, and rows are numbered inside
    their bucket.
    """
    tree = tree or balanced_tree()
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    bucket = F.substring(F.md5(F.concat(F.lit("slot/"), key)), 1, SLOT_DIGITS).alias("_bucket")
    placed = docs.select("doc_id", descend(key, tree).alias("shard"), bucket, "text")
    rows = placed.select(
        "doc_id",
        F.expr("CAST(coalesce(octet_length(text), 0) + 1 AS BIGINT)").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "_bucket",
        descend(key, grown(tree)).alias("grown_shard"),
    )
    counts = placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    first = counts.select(
        "shard", "_bucket", F.expr("sum(_n) OVER (PARTITION BY shard ORDER BY _bucket) - _n").alias("_first")
    )
    inside = F.expr("row_number() OVER (PARTITION BY shard, _bucket ORDER BY doc_id, text_crc32, size)").alias("_place")
    return (
        rows.select("*", inside)
        .join(first, ["shard", "_bucket"])
        .select("doc_id", "size", "text_crc32", "law", "shard", (F.col("_first") + F.col("_place") - 1).alias("slot"), "grown_shard")
    )
