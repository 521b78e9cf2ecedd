"""Merkle manifest of a table: nodes are labelled by the leaf ranks they cover, and joined by containment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge.session import Workspace

FANOUT = 8
TAMPERED_ONE_IN = 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_COVERS = "low = 0 AND high = total"  # a node that covers all leaves is its tree's root


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    """SHA-256 over the fields of a document, each with its length, so that no two rows run together."""
    before = [_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*before, _field(text)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree (the language), the digest, and the digest that a tampered copy of the row would claim."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_ONE_IN == 0
    claimed = F.when(hit, leaf_digest(F.translate("text", _UPPER, _LOWER))).otherwise(F.col("digest"))
    made = docs.select("doc_id", "source", "lang", "n_chars", "text").withColumn("digest", leaf_digest(F.col("text")))
    return made.select("doc_id", F.col("lang").alias("tree"), "digest", claimed.alias("claimed"))


def labelled(rows: DataFrame, order: Sequence[str], work: Workspace, name: str) -> DataFrame:
    """``rows`` with the interval ``low`` to ``high`` of their rank in their tree, and the tree's ``total``.

    Rows are sorted over ranges, not gathered by tree: a task counts its own rows per tree, and what earlier tasks
    counted is added, one small row per task and tree. Rows that agree in all of ``order`` are told apart by their
    place in the table, which spreads them too.
    """
    placed = work.store(rows.withColumn("_row", F.monotonically_increasing_id()), f"{name}-rows")
    keys = ["tree", *order, "_row"]
    dealt = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
    ranked = work.store(dealt.withColumn("_place", F.monotonically_increasing_id()), f"{name}-sorted")
    task = F.shiftright("_place", 33)
    counts = ranked.groupBy(task.alias("_task"), F.col("tree").alias("_tree")).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    tree = Window.partitionBy("_tree")
    upto = tree.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = work.store(
        counts.select(
            "_task", "_tree", (F.coalesce(F.sum("_n").over(upto), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(tree).alias("total")
        ),
        f"{name}-starts",
    )
    low = F.col("_place") + F.col("_shift")
    joined = ranked.join(starts, (task == F.col("_task")) & F.col("tree").eqNullSafe(F.col("_tree")))
    return joined.select(*rows.columns, low.alias("low"), (low + 1).alias("high"), "total")


def forest(base: DataFrame, work: Workspace, name: str) -> list[DataFrame]:
    """Levels of nodes over labelled leaves, each with tree, low, high, total, digest and (above leaves) members.

    Every ``FANOUT`` consecutive nodes become one, until one covers the tree. Groups have ``FANOUT`` members at most,
    and each level is that much smaller than the one below.
    """
    levels, width = [work.store(base, f"{name}-0")], 1
    largest = levels[0].agg(F.max("total")).first()[0] or 0
    while width < largest:
        width *= FANOUT
        below = levels[-1].where(f"NOT ({_COVERS})")
        start = F.expr(f"low div {width}") * width
        member = F.struct("low", "high", "digest")
        grouped = below.groupBy("tree", "total", start.alias("start")).agg(F.array_sort(F.collect_list(member)).alias("members"))
        level = grouped.select(
            "tree",
            F.col("start").alias("low"),
            F.least(F.col("start") + width, F.col("total")).alias("high"),
            "total",
            F.sha2(F.array_join(F.col("members.digest"), ""), 256).alias("digest"),
            "members",
        )
        levels.append(work.store(level, f"{name}-{len(levels)}"))
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """tree and digest of the node that covers each tree."""
    return reduce(DataFrame.unionByName, [level.where(_COVERS).select("tree", "digest") for level in levels])


def _side(members: str, outside: str) -> Column:
    """Digests of a parent's members whose interval lies on one side of the child's."""
    return F.array_join(F.expr(f"transform(filter({members}, m -> {outside}), m -> m.digest)"), "")


def _descended(children: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """Children with their parent's carried columns, and the siblings that the interval difference leaves.

    Intervals meet inside buckets of the parents' width, so each child finds one parent and no key is large.
    """
    up = parents.select(
        *[F.col(c).alias(f"_{c}") for c in ("tree", "low", "high", "members", "path")], "subroot"
    )
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.expr(f"low div {width}") == F.expr(f"_low div {width}"))
    inside = (F.col("_low") <= F.col("low")) & (F.col("high") <= F.col("_high"))
    step = F.struct(_side("_members", "m.high <= low").alias("left"), _side("_members", "m.low >= high").alias("right"))
    path = F.concat(F.array(step), F.col("_path")).alias("path")
    return children.join(up, same & inside).select(*children.columns, path, "subroot")


def with_paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Leaves with ``path``, the siblings left and right of each ancestor from the leaf up, and ``subroot``.

    ``tops`` has tree, subroot and the path above each tree's root. Paths grow from the roots down, level by level.
    """
    above = tops.select(F.col("tree").alias("_tree"), "subroot", "path")
    carried = None
    for number in range(len(levels) - 1, -1, -1):
        nodes = levels[number]
        top = nodes.where(_COVERS).join(above, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
        if carried is None:
            carried = top
            continue
        children = nodes.where(f"NOT ({_COVERS})")
        carried = top.unionByName(_descended(children, carried, FANOUT ** (number + 1)))
    return carried


def _folded(leaf: str) -> Column:
    return F.aggregate("path", F.col(leaf), lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def manifest(docs: DataFrame, work: Workspace) -> DataFrame:
    """A proof for every row that it belongs to the table, and whether a tampered copy passes it.

    Leaves are grouped by language and ordered by doc_id; rows with one doc_id in a language are ordered by their
    digest. The languages' roots, null first, form a tree of their own. Returns one row per input row: doc_id, leaf,
    subroot, root, proof_sha256, folded_root and verified. Where 3 divides the checksum of the doc_id, the leaf that is
    folded up comes from the text with A-Z in lower case; a row without an id is folded as it is.

    Null columns have a mark of their own, so a null text differs from an empty one. Repeated rows are leaves of their
    own. An empty table has no rows. Columns beyond doc_id, source, lang, n_chars and text are ignored.
    """
    levels = forest(labelled(leaves(docs), ["doc_id", "digest"], work, "leaves"), work, "level")
    subroots = roots(levels).select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest")
    upper = forest(labelled(subroots, ["lang"], work, "subroots"), work, "upper")
    whole = roots(upper).first()
    start = docs.sparkSession.createDataFrame([("", "", [])], "tree string, subroot string, path array<struct<left:string,right:string>>")
    tops = with_paths(upper, start).select(F.col("lang").alias("tree"), F.col("digest").alias("subroot"), "path")
    found = with_paths(levels, work.store(tops, "tops"))
    proof = F.concat_ws("", F.transform("path", lambda step: F.concat(step["left"], step["right"])))
    return found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(whole.digest if whole else None).cast("string").alias("root"),
        F.sha2(proof, 256).alias("proof_sha256"),
        _folded("claimed").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
