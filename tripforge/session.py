"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import copy
import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites of column functions help debugging only; each costs round trips to the JVM.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def cluster_settings(input_bytes: int) -> dict[str, str]:
    """Settings for a session that will shuffle about ``input_bytes``.

    Full-row distinct shuffles the whole table, so partitions are sized from it;
    adaptive execution merges those that turn out small.
    """
    partitions = max(200, -(-input_bytes // SHUFFLE_PARTITION_BYTES))
    return {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(SHUFFLE_PARTITION_BYTES),
    }


def local_session(
    cores: int | str = "*", memory: str = "8g", app: str = "tripforge", settings: dict[str, str] | None = None
) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitter's settings rule."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _test_folder() -> str:
    return tempfile.mkdtemp(prefix="tripforge-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor sees, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.startswith("local"):
        return _test_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def require_utc(spark: SparkSession) -> None:
    """Raise where times would be read in another zone than UTC, which would shift hours and dates."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise RuntimeError(f"times are UTC: set spark.sql.session.timeZone to UTC, not {zone}")


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several passes need the same expensive rows: it cuts lineage,
    survives the loss of executors, and later passes read only the columns and
    row groups they need.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Workspace:
    """Tables that one run of an operator keeps in the shared folder.

    ``store`` writes a table once and reads it back, as ``stored`` does;
    ``drop`` deletes tables that no later step reads. What a returned DataFrame
    still reads stays until the driver ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path = spark, new_path(spark, label)
        atexit.register(self.close)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def inner(self, name: str) -> Workspace:
        """A workspace inside this one, which ``drop`` deletes by its name."""
        made = copy.copy(self)
        made.path = f"{self.path}/{name}"
        return made

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.path}/{name}")

    def close(self) -> None:
        try:
            self._delete(self.path)
        except Exception:  # the session has ended; the folder's owner clears it
            return

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
