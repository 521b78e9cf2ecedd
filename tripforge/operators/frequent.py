"""The most frequent values of columns, exact for lists of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripforge.operators.ranking import numbered
from tripforge.session import Workspace

BUCKETS = 1 << 16  # counters of the sketch per column
HEAVY_PER_VALUE = 4  # buckets counted first for each value asked for


def _floors(counts: DataFrame, top: int) -> DataFrame:
    """Per column the count of its ``top``-th most frequent value; columns with fewer values have none.

    Values are counted by their count, so a task sees a number per different count only.
    """
    by_count = counts.groupBy("column", "n").agg(F.count(F.lit(1)).alias("values"))
    upto = Window.partitionBy("column").orderBy(F.desc("n"))
    reached = by_count.withColumn("upto", F.sum("values").over(upto)).filter(F.col("upto") >= top)
    return reached.groupBy("column").agg(F.max("n").alias("floor"))


def frequent_values(tall: DataFrame, top: int, buckets: int = BUCKETS) -> DataFrame:
    """column, value, n and rank of the ``top`` most frequent values of each column of ``tall`` (column, value).

    A sketch adds rows up by a hash of the value; it merges by addition, and no
    value is more frequent than its bucket is full. The values of the fullest
    buckets are counted first. The count of the ``top``-th of them is a floor
    below which no bucket can hold a value of the list, so only the buckets above
    it are counted as well. Equal counts are in the order of the values, a missing
    value first.
    """
    work = Workspace(tall.sparkSession, "frequent")
    bucketed = tall.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int"))
    sketch = work.store(bucketed.groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("full")), "sketch")
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("full"), "bucket"))
    heavy = sketch.withColumn("place", place).filter(F.col("place") <= HEAVY_PER_VALUE * top)

    def counted(some: DataFrame) -> DataFrame:
        # At most ``buckets`` small rows a column: a constant bound.
        chosen = bucketed.join(F.broadcast(some.select("column", "bucket")), ["column", "bucket"])
        return chosen.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))

    counts = work.store(counted(heavy), "counts")
    floors = work.store(_floors(counts, top), "floors")
    others = sketch.join(F.broadcast(heavy.select("column", "bucket")), ["column", "bucket"], "left_anti")
    others = others.join(F.broadcast(floors), "column", "left").filter(F.col("full") >= F.coalesce("floor", F.lit(0)))
    if not others.isEmpty():
        counts = work.store(counts.unionByName(counted(others)), "all-counts")
        floors = work.store(_floors(counts, top), "all-floors")
    able = counts.join(F.broadcast(floors), "column", "left").filter(F.col("n") >= F.coalesce("floor", F.lit(0))).drop("floor")
    ranked = numbered(able, [F.desc("n"), F.asc_nulls_first("value")], ["column"], "rank")
    return ranked.filter(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("int"))
