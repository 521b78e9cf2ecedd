"""Dataset manifests: what a set of files holds, byte for byte and row for row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 8 * 1024 * 1024
FANOUT = 1_024


def _opener() -> Callable:
    """A function that opens a file by its name. It travels to executors by value, so they need not have this package."""

    def opened(name):
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        scheme, _, rest = name.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
        try:
            system, path = fs.FileSystem.from_uri(quote(name.replace("s3a://", "s3://", 1), safe=":/@"))
        except pa.ArrowInvalid as unknown:
            raise ValueError(f"no reader for the scheme of {name}; use file, hdfs, s3a, gs or abfs") from unknown
        return system.open_input_file(path)

    return opened


def _hasher(block_bytes: int) -> Callable:
    """Digests of ranges of files (file, start, bytes), each read in blocks."""
    opened = _opener()

    def hash_ranges(batches):
        import hashlib

        for batch in batches:
            digests = []
            for name, start, size in zip(batch["file"], batch["start"], batch["bytes"]):
                digest, left = hashlib.sha256(), int(size)
                with opened(name) as source:
                    source.seek(int(start))
                    while left and (block := source.read(min(block_bytes, left))):
                        digest.update(block)
                        left -= len(block)
                if left:
                    raise ValueError(f"{name} became shorter while it was read")
                digests.append(digest.hexdigest())
            yield batch.assign(sha256=digests)

    return hash_ranges


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """file and bytes of every file below ``path``, empty ones too. No content is read.

    Spark's own listing leaves empty files out; they are added from the file system's.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = files.select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listing = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(where, True)
    empty = []
    while listing.hasNext():
        status = listing.next()
        if status.getLen() == 0 and not status.getPath().getName().startswith(("_", ".")):
            empty.append((status.getPath().toString(), 0))
    return found.filter("length > 0").unionByName(spark.createDataFrame(empty, "file string, bytes bigint"))


def file_hashes(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per file: name, size and SHA-256 of the content.

    Every file, whatever its length, streams through a task in blocks, so memory
    does not grow with it; a scheme that can't be read raises.
    """
    files = listed_files(spark, path).select("file", F.lit(0).cast("bigint").alias("start"), "bytes").repartition("file")
    schema = "file string, start bigint, bytes bigint, sha256 string"
    return files.mapInPandas(_hasher(block_bytes), schema).drop("start")


def block_hashes(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of each file: file, block, bytes and sha256. Blocks of one file are hashed side by side."""
    blocks = F.greatest(F.ceil(F.col("bytes") / block_bytes), F.lit(1))
    each = listed_files(spark, path).select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block"))
    start = F.col("block") * block_bytes
    ranges = each.select("file", "block", start.alias("start"), F.least(F.lit(block_bytes), F.col("bytes") - start).cast("bigint").alias("bytes"))
    schema = "file string, block bigint, start bigint, bytes bigint, sha256 string"
    return ranges.repartition("file", "block").mapInPandas(_hasher(block_bytes), schema).drop("start")


def file_trees(blocks: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """One row per file: bytes, number of blocks, and the root of a hash tree over its blocks.

    ``blocks`` should be stored. A node's digest is that of its up to ``fanout``
    children's, so no task gathers the blocks of a long file.
    """
    sizes = blocks.groupBy("file").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("blocks"))
    level, most = blocks.select("file", "block", "sha256"), blocks.agg(F.max("block")).first()[0] or 0
    while True:
        pair = F.struct("block", "sha256")
        level = level.groupBy("file", F.expr(f"block div {fanout}").alias("up")).agg(F.array_sort(F.collect_list(pair)).alias("below"))
        level = level.select("file", F.col("up").alias("block"), F.sha2(F.array_join("below.sha256", ""), 256).alias("sha256"))
        most //= fanout
        if not most:
            return sizes.join(level.select("file", F.col("sha256").alias("tree_sha256")), "file")


def changed_blocks(before: DataFrame, after: DataFrame) -> DataFrame:
    """file and block of every block that differs between two stored lists of blocks, or that only one of them has."""
    key = ["file", "block"]
    sides = before.select(*key, F.col("sha256").alias("_old")).join(after.select(*key, F.col("sha256").alias("_new")), key, "full")
    return sides.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(*key)


def row_fingerprint(df: DataFrame) -> DataFrame:
    """One row: row count, column names, and a sum of row hashes.

    The sum ignores row order and file layout, so two tables with equal rows
    agree even where their files differ.
    """
    hashed = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(hashed), F.lit(0).cast("decimal(38,0)")).cast("string").alias("fingerprint"),
    ).withColumn("columns", F.array(*[F.lit(c) for c in df.columns]))


def manifest(spark: SparkSession, path: str, table: DataFrame | None = None) -> DataFrame:
    """One row per file with the table's columns, row count and fingerprint beside it."""
    table = table if table is not None else spark.read.option("header", True).csv(path)
    rows = row_fingerprint(table).first()
    return file_hashes(spark, path).withColumns(
        {
            "columns": F.array(*[F.lit(c) for c in rows["columns"]]),
            "table_rows": F.lit(rows["rows"]),
            "table_fingerprint": F.lit(rows["fingerprint"]),
        }
    )
