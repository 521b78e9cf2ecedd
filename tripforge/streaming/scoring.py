"""Scoring of requests as they arrive: the batch checks and expressions over a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripforge.operators.scoring import checked_requests, rejected, score_requests
from tripforge.schema import REQUEST_SCHEMA


def request_stream(spark: SparkSession, folder: str, format: str = "json", files_per_batch: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    return reader.format(format).load(folder)


def _append(df: DataFrame, path: str, checkpoint: str, once: bool) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def score_stream(requests: DataFrame, model, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append the durations of acceptable requests. No state: every row stands alone."""
    return _append(score_requests(requests, model), path, checkpoint, once)


def reject_stream(requests: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append the requests that fail a check, with the fields at fault."""
    return _append(rejected(checked_requests(requests)), path, checkpoint, once)
