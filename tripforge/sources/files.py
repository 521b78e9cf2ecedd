"""Readers and writers for every table the jobs exchange."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.operators.validate import CheckedTrips, check_trips, require_columns
from tripforge.schema import FEATURE_COLUMNS, FEATURE_DESCRIPTIONS, METADATA_SCHEMA, TARGET, TRIP_COLUMNS, text_schema
from tripforge.session import require_utc


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header; only the first line is read."""
    return spark.read.option("header", True).csv(path).columns


# What a CSV field may hold in place of a missing value.
MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def without_markers(table: DataFrame) -> DataFrame:
    """Text columns with NULL where a field holds a marker of a missing value."""
    return table.select(*[F.when(~F.col(c).isin(*MISSING_MARKERS), F.col(c)).alias(c) for c in table.columns])


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV table with every column as text, in the order of its own header.

    Fields that hold a marker of a missing value are NULL. Files of one folder
    must share their header; another order of columns fails when it is read.
    Times are UTC, so a session in another zone is refused.
    """
    require_utc(spark)
    schema = text_schema(csv_columns(spark, path))
    return without_markers(spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path))


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    trips = read_text_table(spark, path)
    require_columns(trips)
    return trips.select(*TRIP_COLUMNS)


def read_checked_trips(spark: SparkSession, path: str) -> CheckedTrips:
    return check_trips(read_trips(spark, path))


def read_weather(spark: SparkSession, path: str) -> DataFrame | None:
    """The optional weather table in either layout; None where the path does not exist."""
    try:
        return read_text_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_features(spark: SparkSession, path: str, columns=(*FEATURE_COLUMNS, TARGET), key: str | None = "id") -> DataFrame:
    """The named columns of a feature table; Parquet reads no others."""
    keys = [key] if key else []
    return spark.read.parquet(path).select(*keys, *columns)


def write_table(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Replace the table at ``path``."""
    writer = df.write.mode("overwrite")
    if format == "csv":
        writer = writer.option("header", True)
    writer.format(format).save(path)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_tables(tables: dict[str, DataFrame], folder: str, format: str = "parquet") -> None:
    """Small result tables (summaries, comparisons, metrics), one folder each."""
    for name, table in tables.items():
        write_table(table, f"{folder}/{name}", format)


def feature_metadata(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FEATURE_DESCRIPTIONS, METADATA_SCHEMA)


def write_feature_metadata(spark: SparkSession, path: str) -> None:
    write_table(feature_metadata(spark).coalesce(1), path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
