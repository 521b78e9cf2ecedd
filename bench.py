"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` (optional, comma-separated) a choice of queries. With
``BENCH_TRIPS`` set, the trip table is first copied up to about that many rows
under new ids and event numbers, for a run at the size of a real year of trips.
"""

from __future__ import annotations

import json
import math
import os
import time

from pyspark.sql import functions as F

from tripforge.plans import catalog
from tripforge.session import local_session, new_path

HEADLINE = [
    "hourly_trip_profile",
    "valid_trip_rows",
    "validation_report",
    "csv_trips_checked",
    "trips_with_weather",
    "trip_distances",
    "trimmed_trip_rows",
    "below_upper_percentiles",
    "missing_values",
    "numeric_summary",
    "lineitem_numeric_summary",
    "text_value_counts",
    "correlation_matrix",
    "distance_duration_correlation",
    "median_minutes_by_hour",
    "rush_hour_summary",
    "distance_histogram",
    "price_quantiles",
    "price_quantiles_by_part",
    "frequent_line_keys",
    "report_of_loads",
    "feature_rows",
    "fixed_size_sample",
    "exact_split",
    "merged_sample",
    "feature_numbers",
    "model_comparison",
    "largest_errors",
    "drift_metrics",
    "drift_by_weekday",
    "formula_durations",
    "linear_regression_metrics",
]


def enlarged(spark, folder: str, trips: int) -> str:
    """A folder with the events table repeated under new event numbers, and lineitem as it is."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    rows = events.count()
    times = math.ceil(trips / rows)
    target = new_path(spark, "bench")
    copies = events.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    spread = copies.withColumns(
        {"event_id": F.col("event_id") + F.col("_copy") * rows, "value": F.col("value") + F.col("_copy") / times}
    ).drop("_copy")
    spread.repartition(16).write.parquet(f"{target}/events.parquet")
    spark.read.parquet(f"{folder}/lineitem.parquet").write.parquet(f"{target}/lineitem.parquet")
    return target


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    trips = int(os.environ.get("BENCH_TRIPS", "0"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cores, memory="12g", app="tripforge-bench")
    source = enlarged(spark, folder, trips) if trips else folder
    # The engine loads and compiles its own classes on first use: once before the clock.
    catalog.QUERIES["hourly_trip_profile"](spark, source).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, source).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    rows = spark.read.parquet(f"{source}/events.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "trips": rows,
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
