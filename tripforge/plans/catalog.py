"""Queries over the given tables, one or more for every operator.

Each takes a session and a folder of Parquet tables and works on whole tables.
Times leave as epoch seconds and doubles rounded to six places, so that results
can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.functions.calendar import form_parts, weekday_name, with_pickup_parts
from tripforge.functions.measures import minutes, rounded_even
from tripforge.operators import drift, enrich, features, metrics, models, outliers, profile, sample, scoring, validate
from tripforge.operators.accepted import AcceptedTrips
from tripforge.plans import preparation, reports, training
from tripforge.schema import FEATURE_COLUMNS, NUMBER_COLUMNS, TARGET, WEATHER_MEASURES
from tripforge.session import new_path, stored
from tripforge.sources import driver_tables as tables
from tripforge.sources import files, manifest
from tripforge.streaming.validation import arriving_trips, validate_arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WATCHED_INPUTS = ["distance_km", "pickup_hour", "pickup_weekday", *WEATHER_MEASURES]
PLANAR_MODELS = {"near": (300.0, 120.0), "flat": (4000.0, 0.0), "steep": (-500.0, 900.0)}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def epoch(column: str) -> Column:
    return F.unix_timestamp(column)


def comparable(df: DataFrame) -> DataFrame:
    """Times as epoch seconds, doubles to six places without a negative zero."""
    changed = {}
    for field in df.schema:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            changed[field.name] = epoch(field.name)
        elif isinstance(field.dataType, T.DoubleType):
            changed[field.name] = rounded_even(F.col(field.name), 6) + F.lit(0.0)
    return df.withColumns(changed) if changed else df


def _checked(spark: SparkSession, folder: str) -> DataFrame:
    return validate.valid_trips(tables.trips(spark, folder))


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.enriched_trips(_checked(spark, folder), tables.weather(spark, folder))


def _typed(spark: SparkSession, folder: str) -> DataFrame:
    return reports.typed_trips(tables.trips(spark, folder))


def _predicted(spark: SparkSession, folder: str, model: str = "near") -> DataFrame:
    base, per_km = PLANAR_MODELS[model]
    trips = enrich.with_distance(_checked(spark, folder))
    return trips.select(
        "id",
        "distance_km",
        F.col(TARGET).cast("double").alias("actual"),
        (F.lit(base) + F.lit(per_km) * F.col("distance_km")).alias("predicted"),
    )


# --- validation -------------------------------------------------------------


@query
def hourly_trip_profile(spark, folder):
    return comparable(preparation.hourly_trip_profile(tables.trips(spark, folder), tables.weather(spark, folder)))


@query
def valid_trip_rows(spark, folder):
    return comparable(_checked(spark, folder))


@query
def validation_report(spark, folder):
    return validate.validation_report(tables.trips(spark, folder))


@query
def text_validation_report(spark, folder):
    return validate.validation_report(tables.text_trips(spark, folder))


@query
def rule_flags(spark, folder):
    trips = validate.coerced_trips(tables.trips(spark, folder))
    flags = [rule().cast("int").alias(name) for name, rule in validate.RULES.items()]
    return trips.select("id", *flags)


@query
def coerced_text(spark, folder):
    return comparable(validate.coerced_trips(tables.text_trips(spark, folder)))


@query
def csv_trips_checked(spark, folder):
    path = new_path(spark, "trips-csv")
    files.write_table(tables.text_trips(spark, folder), path, "csv")
    return comparable(files.read_checked_trips(spark, path).rows)


def _loaded(spark: SparkSession, folder: str) -> AcceptedTrips:
    """The text trips in three loads, of which the last also repeats a part of the first."""
    accepted = AcceptedTrips(spark, new_path(spark, "accepted"), buckets=8)
    trips = tables.text_trips(spark, folder)
    third = F.pmod(F.xxhash64("id", "passenger_count", "dropoff_datetime"), F.lit(3))
    for number in range(3):
        accepted.load(trips.filter(third == number), f"load-{number}")
    return accepted


@query
def report_of_loads(spark, folder):
    """Loads one after another report together what the whole table reports."""
    return _loaded(spark, folder).report()


@query
def rows_of_loads(spark, folder):
    return comparable(_loaded(spark, folder).rows())


@query
def report_of_arrivals(spark, folder):
    """CSV files validated as a stream, a few in a batch."""
    path = new_path(spark, "arrivals")
    files.write_table(tables.text_trips(spark, folder).repartition(6), f"{path}/files", "csv")
    accepted = AcceptedTrips(spark, f"{path}/accepted", buckets=8)
    validate_arrivals(arriving_trips(spark, f"{path}/files", 2), accepted, f"{path}/checkpoint").awaitTermination()
    return accepted.report()


@query
def duplicate_rows(spark, folder):
    return validate.duplicate_count(tables.text_trips(spark, folder))


@query
def duplicate_orders_by_status(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderstatus", "o_orderpriority")
    return validate.duplicate_count(orders)


# --- weather, time and distance ----------------------------------------------


@query
def weather_by_hour(spark, folder):
    return comparable(enrich.hourly_weather(tables.weather(spark, folder)))


@query
def exported_weather_by_hour(spark, folder):
    path = new_path(spark, "weather-csv")
    files.write_table(tables.exported_weather(spark, folder), path, "csv")
    return comparable(enrich.hourly_weather(files.read_weather(spark, path)))


@query
def trips_with_weather(spark, folder):
    joined = enrich.with_weather(_checked(spark, folder), tables.weather(spark, folder))
    return comparable(joined.select("id", *WEATHER_MEASURES, "weather_data_available"))


@query
def trips_with_weather_shuffled(spark, folder):
    """The same join beyond the broadcast bound: salted and shuffled."""
    joined = enrich.with_weather(_checked(spark, folder), tables.weather(spark, folder), broadcast_hours=0)
    return comparable(joined.select("id", *WEATHER_MEASURES, "weather_data_available"))


@query
def trips_without_weather(spark, folder):
    missing = files.read_weather(spark, f"{folder}/no_such_weather.csv")
    trips = enrich.with_weather(_checked(spark, folder), missing)
    return trips.agg(
        F.count(F.lit(1)).alias("trips"),
        F.count("temperature_c").alias("with_temperature"),
        F.sum("weather_data_available").alias("available"),
    )


@query
def pickup_parts(spark, folder):
    trips = with_pickup_parts(_checked(spark, folder))
    return trips.select(
        "id",
        "pickup_hour",
        "pickup_day",
        "pickup_month",
        "pickup_weekday",
        weekday_name(F.col("pickup_weekday")).alias("weekday_name"),
        "is_weekend",
        "rush_hour",
    )


@query
def form_pickup_parts(spark, folder):
    moment = F.col("pickup_datetime")
    parts = form_parts(F.to_date(moment), F.date_format(moment, "HH:mm"))
    return _checked(spark, folder).select("id", *[value.alias(name) for name, value in parts.items()])


@query
def trip_distances(spark, folder):
    return comparable(outliers.finite_rows(_enriched(spark, folder), ["distance_km"]).select("id", "distance_km"))


# --- filters -----------------------------------------------------------------


@query
def iqr_kept_trips(spark, folder):
    trips = enrich.with_distance(_checked(spark, folder))
    kept = outliers.within_iqr(stored(trips.select("id", "distance_km", TARGET), "iqr"), TARGET)
    return comparable(kept)


@query
def iqr_chain_report(spark, folder):
    usable = preparation.usable_trips(tables.trips(spark, folder), tables.weather(spark, folder))
    _, fences = preparation.trimmed_trips(usable)
    return comparable(outliers.fence_report(usable, fences))


@query
def trimmed_trip_rows(spark, folder):
    usable = preparation.usable_trips(tables.trips(spark, folder), tables.weather(spark, folder))
    trips, _ = preparation.trimmed_trips(usable)
    return comparable(trips.select("id", "distance_km", "passenger_count", TARGET))


@query
def below_upper_percentiles(spark, folder):
    usual = outliers.within_upper_percentile(
        profile.moved_trips_in_minutes(_typed(spark, folder)), ["distance_km", "duration_minutes"]
    )
    return comparable(usual)


# --- exploratory statistics ---------------------------------------------------


@query
def table_shape(spark, folder):
    return profile.row_and_column_count(tables.trips(spark, folder))


@query
def missing_values(spark, folder):
    return comparable(profile.missing_summary(tables.trips(spark, folder)))


@query
def columns_with_missing_values(spark, folder):
    return comparable(profile.missing_columns(validate.coerced_trips(tables.text_trips(spark, folder))))


@query
def numeric_summary(spark, folder):
    return comparable(profile.describe(tables.trips(spark, folder), NUMBER_COLUMNS))


@query
def lineitem_numeric_summary(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return comparable(profile.describe(lines))


@query
def text_value_counts(spark, folder):
    trips = tables.trips(spark, folder)
    return profile.value_counts(trips).select("column", "value", "n", "rank")


@query
def order_value_counts(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return profile.value_counts(orders, top=3).select("column", "value", "n", "rank")


@query
def frequent_line_keys(spark, folder):
    """A list too long for one task to rank: the 5,000 most frequent keys of the lines."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"]
    return profile.value_counts(lines, keys, top=5_000).select("column", "value", "n", "rank")


@query
def invalid_pickup_times(spark, folder):
    return profile.missing_times(validate.coerced_trips(tables.text_trips(spark, folder)))


@query
def trips_by_hour(spark, folder):
    return profile.counts_by(_typed(spark, folder), "pickup_hour")


@query
def trips_by_weekday(spark, folder):
    return profile.counts_by_weekday(_typed(spark, folder))


@query
def trips_by_month(spark, folder):
    return profile.counts_by(_typed(spark, folder), "pickup_month")


@query
def trips_by_passengers(spark, folder):
    return comparable(profile.counts_by_passengers(tables.text_trips(spark, folder)))


@query
def gps_summary(spark, folder):
    return comparable(profile.gps_summary(tables.text_trips(spark, folder)))


@query
def city_distance_summary(spark, folder):
    return comparable(profile.describe(profile.city_distances(tables.trips(spark, folder)), ["distance_km"]))


@query
def duration_summary(spark, folder):
    return comparable(profile.describe(tables.trips(spark, folder), [TARGET]))


@query
def correlation_matrix(spark, folder):
    return comparable(profile.correlation_matrix(_typed(spark, folder)))


@query
def distance_duration_correlation(spark, folder):
    return comparable(profile.distance_duration_correlation(_typed(spark, folder)))


@query
def median_minutes_by_hour(spark, folder):
    return comparable(profile.median_minutes_by_hour(_typed(spark, folder)))


@query
def rush_hour_summary(spark, folder):
    return comparable(profile.rush_hour_summary(_typed(spark, folder)))


@query
def distance_histogram(spark, folder):
    return comparable(profile.histogram(profile.city_distances(tables.trips(spark, folder)), "distance_km"))


@query
def duration_histogram(spark, folder):
    trips = tables.trips(spark, folder).select(minutes(F.col(TARGET)).alias("duration_minutes"))
    return comparable(profile.histogram(trips, "duration_minutes"))


def _wide_quantiles(df: DataFrame) -> DataFrame:
    names = ["q01", "q25", "q50", "q99"]
    return comparable(df.select("column", *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(names)]))


@query
def price_quantiles(spark, folder):
    from tripforge.operators.quantiles import quantiles

    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return _wide_quantiles(quantiles(lines, ["l_extendedprice", "l_quantity"], [0.01, 0.25, 0.5, 0.99]))


@query
def price_quantiles_by_rank(spark, folder):
    """The same quantiles by the method for columns with too many values for one task."""
    from tripforge.operators.quantiles import quantiles

    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    found = quantiles(lines, ["l_extendedprice", "l_quantity"], [0.01, 0.25, 0.5, 0.99], max_values=2_000, cells=64)
    return _wide_quantiles(found)


@query
def price_quantiles_by_part(spark, folder):
    """Quantiles of every part's lines, each part too large for one task by its setting."""
    from tripforge.operators.quantiles import quantiles

    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    found = quantiles(lines, ["l_extendedprice", "l_quantity"], [0.25, 0.5], by=["l_partkey"], max_values=5, cells=16)
    names = ["q25", "q50"]
    return comparable(
        found.select("l_partkey", "column", *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(names)])
    )


# --- features ----------------------------------------------------------------


@query
def feature_rows(spark, folder):
    prepared = preparation.prepare(tables.trips(spark, folder), tables.weather(spark, folder), fit_on="all")
    return comparable(features.feature_rows(prepared.processed))


@query
def feature_rows_fitted_on_train(spark, folder):
    prepared = preparation.prepare(tables.trips(spark, folder), tables.weather(spark, folder))
    return comparable(features.feature_rows(prepared.processed))


@query
def feature_rows_without_weather(spark, folder):
    prepared = preparation.prepare(tables.trips(spark, folder), None, fit_on="all")
    return comparable(features.feature_rows(prepared.processed))


@query
def processed_summary(spark, folder):
    prepared = preparation.prepare(tables.trips(spark, folder), tables.weather(spark, folder), fit_on="all")
    return comparable(profile.describe(stored(prepared.processed, "processed"), [*FEATURE_COLUMNS, TARGET]))


@query
def stored_feature_scan(spark, folder):
    """Write the feature table, then read three of its columns."""
    path = new_path(spark, "feature-table")
    prepared = preparation.prepare(tables.trips(spark, folder), tables.weather(spark, folder), fit_on="all")
    preparation.build_feature_table(prepared.processed, path)
    return comparable(files.read_features(spark, path, ["num__distance_km", TARGET]))


@query
def feature_ids(spark, folder):
    """Row ids of the written feature table are unique."""
    path = new_path(spark, "feature-ids")
    rows = outliers.finite_rows(_enriched(spark, folder), ["distance_km"]).select("id", "distance_km")
    files.write_table(features.with_feature_id(rows), path)
    ids = spark.read.parquet(path)
    return ids.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("feature_id").alias("distinct_ids"))


@query
def feature_numbers(spark, folder):
    """Ids of the written feature table run from 1 without a gap, in the order of the trips' ids."""
    path = new_path(spark, "feature-numbers")
    rows = outliers.finite_rows(_enriched(spark, folder), ["distance_km"]).select("id", "distance_km")
    files.write_table(features.with_feature_id(rows), path)
    return comparable(spark.read.parquet(path).select("feature_id", "id", "distance_km"))


@query
def preview(spark, folder):
    return comparable(profile.first_rows(_checked(spark, folder), 10, ["id"]))


# --- samples and splits --------------------------------------------------------


def _stored_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of the valid trips, stored: sampling passes over them more than once."""
    return stored(_checked(spark, folder).select("id"), "ids")


@query
def fixed_size_sample(spark, folder):
    return sample.sample_rows(_stored_ids(spark, folder), "id", 2_000)


@query
def merged_sample(spark, folder):
    """The sample of all trips from samples of four parts of them."""
    ids = _stored_ids(spark, folder)
    part = F.pmod(F.xxhash64("id"), F.lit(4))
    return sample.merged_sample([sample.sample_rows(ids.filter(part == i), "id", 1_500) for i in range(4)], "id", 1_500)


@query
def hashed_split(spark, folder):
    return _checked(spark, folder).select("id", sample.in_test_share("id").cast("int").alias("is_test"))


@query
def exact_split(spark, folder):
    train, test = sample.split_rows(_stored_ids(spark, folder), "id", exact=True)
    return train.withColumn("is_test", F.lit(0)).unionByName(test.withColumn("is_test", F.lit(1)))


@query
def tuning_sample(spark, folder):
    train, _ = sample.split_rows(_stored_ids(spark, folder), "id")
    return sample.sample_rows(train, "id", 1_000)


# --- metrics and errors ---------------------------------------------------------


@query
def regression_metrics(spark, folder):
    return comparable(metrics.regression_metrics(_predicted(spark, folder)))


def _compared(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of all models from one pass over the trips."""
    guesses = [
        F.struct(F.lit(name).alias("Model"), (F.lit(base) + F.lit(per_km) * F.col("distance_km")).alias("predicted"))
        for name, (base, per_km) in PLANAR_MODELS.items()
    ]
    trips = enrich.with_distance(_checked(spark, folder)).select("distance_km", F.col(TARGET).cast("double").alias("actual"))
    return metrics.metrics_by_model(trips.select("actual", F.inline(F.array(*guesses))))


@query
def model_comparison(spark, folder):
    return comparable(_compared(spark, folder).orderBy("RMSE", "Model"))


@query
def best_of_comparison(spark, folder):
    return comparable(metrics.best_model(_compared(spark, folder)))


@query
def largest_errors(spark, folder):
    """Test rows of the feature side joined by key to separately stored predictions."""
    test = stored(sample.split_rows(_predicted(spark, folder), "id")[1], "predicted")
    predictions = test.select("id", "actual", "predicted")
    return comparable(metrics.largest_errors_with_features(test.drop("actual", "predicted"), predictions))


@query
def error_summary(spark, folder):
    return comparable(metrics.error_summary(_predicted(spark, folder)))


# --- drift ------------------------------------------------------------------


def _halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = stored(_enriched(spark, folder).select("id", *WATCHED_INPUTS), "drift-inputs")
    morning = F.col("pickup_hour") < 12
    return rows.filter(morning), rows.filter(~morning)


@query
def drift_metrics(spark, folder):
    reference, current = _halves(spark, folder)
    found = drift.drift_metrics(reference, current, WATCHED_INPUTS)
    return comparable(found.withColumn("drift_detected", F.col("drift_detected").cast("int")))


@query
def drift_of_longer_trips(spark, folder):
    rows = stored(_enriched(spark, folder).select("distance_km"), "drift-distance")
    longer = rows.select((F.col("distance_km") + 0.35).alias("distance_km"))
    found = drift.drift_metrics(rows, longer, ["distance_km"])
    return comparable(found.withColumn("drift_detected", F.col("drift_detected").cast("int")))


@query
def drift_by_weekday(spark, folder):
    """Afternoon trips of every weekday against a stored profile of the morning trips, in one scan."""
    reference, current = _halves(spark, folder)
    path = new_path(spark, "profile")
    files.write_table(drift.reference_profile(reference, ["distance_km", "temperature_c"]), path)
    found = drift.compared(spark.read.parquet(path), current, ["pickup_weekday"])
    return comparable(found.withColumn("drift_detected", F.col("drift_detected").cast("int")))


@query
def drift_report(spark, folder):
    reference, current = _halves(spark, folder)
    report = drift.drift_report(drift.drift_metrics(reference, current, WATCHED_INPUTS))
    return report.select(
        "watched_features",
        F.concat_ws(",", "drifted_features").alias("drifted_features"),
        F.col("retraining_triggered").cast("int").alias("retraining_triggered"),
        "psi_threshold",
    )


# --- scoring ------------------------------------------------------------------


@query
def request_checks(spark, folder):
    checked = scoring.checked_requests(tables.requests(spark, folder))
    return checked.select("request_id", F.concat_ws(",", "_errors").alias("errors"))


@query
def request_inputs(spark, folder):
    good = scoring.accepted(scoring.checked_requests(tables.requests(spark, folder)))
    ready = scoring.with_indicators(scoring.request_inputs(good))
    return ready.select(
        "request_id",
        "is_weekend",
        "rush_hour",
        "weather_data_available",
        "cat__vendor_id_1",
        "cat__vendor_id_2",
        "cat__store_and_fwd_flag_N",
        "cat__store_and_fwd_flag_Y",
    )


@query
def formula_durations(spark, folder):
    good = scoring.accepted(scoring.checked_requests(tables.requests(spark, folder)))
    guess = good.withColumn("prediction", F.col("distance_km") * 90.0 - 600.0)
    return comparable(
        scoring.with_durations(guess).select("request_id", "trip_duration_seconds", "trip_duration_minutes")
    )


# --- learned models -------------------------------------------------------------


def _features(spark: SparkSession, folder: str) -> tuple[DataFrame, preparation.Prepared]:
    prepared = preparation.prepare(tables.trips(spark, folder), tables.weather(spark, folder))
    return preparation.build_feature_table(prepared.processed, new_path(spark, "features")), prepared


@query
def distance_regression(spark, folder):
    """Least squares on distance alone, so that plain SQL can check the fit."""
    rows = stored(enrich.with_distance(_checked(spark, folder)).select("id", "distance_km", TARGET), "regression")
    run = models.run_model(
        "distance", models.linear_regression(), rows, rows, features=["distance_km"]
    )
    fitted = run.model.stages[-1]
    found = run.metrics.withColumns({"slope": F.lit(float(fitted.coefficients[0])), "intercept": F.lit(fitted.intercept)})
    return found.select(*[rounded_even(F.col(c), 4).alias(c) for c in found.columns])


@query
def linear_regression_metrics(spark, folder):
    train, test = sample.split_rows(_features(spark, folder)[0], "id")
    return comparable(models.run_model("Linear Regression", models.linear_regression(), train, test).metrics)


@query
def random_forest_metrics(spark, folder):
    train, test = sample.split_rows(_features(spark, folder)[0], "id")
    return comparable(models.run_model("Random Forest", models.random_forest(), train, test).metrics)


@query
def boosted_trees_metrics(spark, folder):
    train, test = sample.split_rows(_features(spark, folder)[0], "id")
    return comparable(models.run_model("Boosted Trees", models.boosted_trees(), train, test).metrics)


@query
def random_search_results(spark, folder):
    train, _ = sample.split_rows(_features(spark, folder)[0], "id")
    settings = models.drawn_settings()
    _, found = models.random_search(train, settings)
    return comparable(models.search_table(spark, settings, found))


@query
def random_search_coverage(spark, folder):
    """What the search did: trees, rows fitted and rows held out of every setting and fold, and that all were scored."""
    train, _ = sample.split_rows(_features(spark, folder)[0], "id")
    settings = models.drawn_settings()
    best, found = models.random_search(train, settings)
    least = models.mean_errors(found).agg(F.min_by("setting", "mean_rmse")).first()[0]
    return found.select(
        "setting",
        "fold",
        "trees",
        "trained_rows",
        "validated_rows",
        F.coalesce(F.col("rmse") > 0, F.lit(False)).cast("int").alias("scored"),
        F.lit(int(settings[least] == best)).alias("best_is_least"),
    )


@query
def selected_model_importance(spark, folder):
    """Importance of the features in the best of all four models; no rows if the linear one wins."""
    table, _ = _features(spark, folder)
    found = training.select_best(table, training.train_all(table)).importance
    return spark.createDataFrame([], "Feature string, Importance double") if found is None else comparable(found)


@query
def scored_requests(spark, folder):
    table, prepared = _features(spark, folder)
    train, test = sample.split_rows(table, "id")
    run = models.run_model("Linear Regression", models.linear_regression(), train, test)
    model = training.scoring_model(prepared.preprocessor, run)
    return comparable(scoring.score_requests(tables.requests(spark, folder), model))


@query
def dataset_manifest(spark, folder):
    table = spark.read.parquet(f"{folder}/events.parquet")
    found = manifest.manifest(spark, f"{folder}/events.parquet", table)
    return found.select(
        F.element_at(F.split("file", "/"), -1).alias("file"),
        "bytes",
        "sha256",
        F.concat_ws(",", "columns").alias("columns"),
        "table_rows",
        "table_fingerprint",
    )


@query
def dataset_blocks(spark, folder):
    """A table's files in blocks of 64 KiB: per file its bytes, blocks and the root of the tree over them."""
    blocks = stored(manifest.block_hashes(spark, f"{folder}/events.parquet", 1 << 16), "blocks")
    return manifest.file_trees(blocks, fanout=4).withColumn("file", F.element_at(F.split("file", "/"), -1))
