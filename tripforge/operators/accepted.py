"""Validation of loads that arrive one after another, judged against all rows accepted so far."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.operators.validate import (
    RULES,
    InvalidTable,
    breaks_any_rule,
    coerced_trips,
    report_of,
    require_columns,
    with_status,
)
from tripforge.schema import TIME_FORMATS
from tripforge.session import Workspace

BUCKETS = 64


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of a row. Every field is written with its length, a missing one with a mark of its own."""
    texts = [F.col(c).cast("string") for c in columns]
    fields = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*fields), 256))


class AcceptedTrips:
    """A growing set of valid, distinct trips in a folder that all executors share.

    ``raw`` and ``accepted`` hold digests of rows seen so far, written in hash
    buckets: a new load is dealt by the same hash and meets them where they lie,
    so old rows are read and never shuffled. ``rows`` holds what was accepted,
    ``quarantine`` what broke a rule, ``loads`` one report a load.

    A load counts once its report is written, which is its last step. What an
    interrupted load left behind is not read again, and the load can be repeated.
    Loads are judged one at a time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, formats: Sequence[str] = TIME_FORMATS):
        self.spark, self.path, self.buckets, self.formats = spark, path, buckets, formats
        name = hashlib.md5(path.encode()).hexdigest()[:16]
        for kind in ("raw", "accepted"):
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._table(kind, name)} (digest BINARY, attempt STRING) USING parquet "
                f"CLUSTERED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}/{kind}'"
            )
        self.name = name

    def _table(self, kind: str, name: str) -> str:
        return f"trips_{kind}_{name}"

    def loads(self) -> DataFrame:
        """The report of every finished load, with its name."""
        counts = ["input_rows", "duplicate_rows", *RULES, "removed_rows", "output_rows"]
        schema = "load string, attempt string, " + ", ".join(f"{c} bigint" for c in counts) + ", status string"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/loads")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise

    def _finished(self, df: DataFrame) -> DataFrame:
        attempts = F.broadcast(self.loads().select(F.col("attempt").alias("_attempt")))  # one small row a load
        return df.join(attempts, F.col("attempt") == F.col("_attempt"), "left_semi")

    def _marked(self, df: DataFrame, kind: str) -> DataFrame:
        """``df``, which has a ``_digest``, with ``_known``: whether a finished load had the row."""
        seen = self._finished(self.spark.table(self._table(kind, self.name))).select("digest", F.lit(True).alias("_seen"))
        joined = df.join(seen, F.col("_digest") == F.col("digest"), "left")
        return joined.withColumn("_known", F.coalesce("_seen", F.lit(False))).drop("digest", "_seen")

    def _append(self, digests: DataFrame, kind: str, attempt: str) -> None:
        rows = digests.select(F.col("_digest").alias("digest"), F.lit(attempt).alias("attempt"))
        dealt = rows.repartition(self.buckets, "digest")  # the buckets' own hash: one file a bucket
        dealt.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").saveAsTable(self._table(kind, self.name))

    def has(self, load: str) -> bool:
        return not self.loads().filter(F.col("load") == load).isEmpty()

    def load(self, raw: DataFrame, load: str) -> DataFrame:
        """Judge the rows of a load, keep what is new and valid, and return the load's report.

        The counts are those that the load adds to the report of all rows
        together: a raw row that an earlier load had is a duplicate, and a valid
        row that was accepted before adds no output.
        """
        require_columns(raw)
        if self.has(load):
            raise ValueError(f"{load} was loaded before")
        attempt, work = uuid.uuid4().hex, Workspace(self.spark, "load")
        columns = raw.columns
        distinct_raw = raw.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_digest", row_digest(columns))
        seen = work.store(self._marked(distinct_raw, "raw"), "raw")
        copies = F.when(F.col("_known"), F.col("_rows")).otherwise(F.col("_rows") - 1)
        counted = coerced_trips(seen.select(*columns, "_rows", copies.alias("_copies")), self.formats)
        grouped = counted.groupBy(*columns).agg(F.sum("_rows").alias("_rows"), F.sum("_copies").alias("_copies"))
        judged = work.store(self._marked(grouped.withColumn("_digest", row_digest(columns)), "accepted"), "judged")
        fresh = ~breaks_any_rule() & ~F.col("_known")
        found = judged.filter(fresh)

        found.select(*columns, F.lit(attempt).alias("attempt")).write.mode("append").partitionBy("attempt").parquet(f"{self.path}/rows")
        broken = F.array_compact(F.array(*[F.when(rule(), F.lit(name)) for name, rule in RULES.items()]))
        bad = judged.filter(breaks_any_rule()).select(*columns, F.col("_rows").alias("copies"), broken.alias("broken_rules"))
        bad.withColumn("attempt", F.lit(attempt)).write.mode("append").partitionBy("attempt").parquet(f"{self.path}/quarantine")
        self._append(seen.filter(~F.col("_known")), "raw", attempt)
        self._append(found, "accepted", attempt)
        report = report_of(judged, fresh).select(F.lit(load).alias("load"), F.lit(attempt).alias("attempt"), "*")
        row = report.first()
        done = self.spark.createDataFrame([row], report.schema)
        done.coalesce(1).write.mode("append").parquet(f"{self.path}/loads")
        work.close()
        return done.drop("load", "attempt")

    def rows(self) -> DataFrame:
        """Valid, distinct rows of all finished loads."""
        return self._finished(self.spark.read.parquet(f"{self.path}/rows")).drop("attempt")

    def quarantine(self) -> DataFrame:
        """Distinct rows of each load that broke a rule, with the names of the rules and the number of copies."""
        return self._finished(self.spark.read.parquet(f"{self.path}/quarantine")).drop("attempt")

    def report(self) -> DataFrame:
        """One row: the report of all loads together."""
        counts = [c for c in self.loads().columns if c not in ("load", "attempt", "status")]
        return with_status(self.loads().agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counts]))

    def require_rows(self) -> AcceptedTrips:
        """Raise when no load left a row."""
        if self.report().first()["output_rows"] == 0:
            raise InvalidTable("Validation removed every row of every load")
        return self
