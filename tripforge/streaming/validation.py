"""Validation of trip files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripforge.operators.accepted import AcceptedTrips
from tripforge.operators.validate import require_columns
from tripforge.schema import TRIP_COLUMNS, text_schema
from tripforge.session import require_utc
from tripforge.sources.files import without_markers


def arriving_trips(spark: SparkSession, folder: str, files_per_batch: int = 1_000) -> DataFrame:
    """A stream of the CSV files of a folder, every column as text. Files share the trip table's header."""
    require_utc(spark)
    reader = spark.readStream.schema(text_schema(TRIP_COLUMNS)).option("header", True).option("enforceSchema", False)
    return without_markers(reader.option("maxFilesPerTrigger", files_per_batch).csv(folder))


def validate_arrivals(trips: DataFrame, accepted: AcceptedTrips, checkpoint: str, source: str = "arrivals") -> StreamingQuery:
    """Load every batch of a stream, then stop when what has arrived is done.

    Reports add up over batches in ``accepted.report()``. A batch that is played
    again after a failure has its report already, and is left out.
    """
    require_columns(trips)

    def load(batch: DataFrame, number: int) -> None:
        name = f"{source}-{number}"
        if not accepted.has(name):
            accepted.load(batch, name)

    return trips.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
