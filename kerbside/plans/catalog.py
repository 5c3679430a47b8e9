"""Every operator as a named query over a folder of order tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside import operators as ops
from kerbside.functions import clean, trip_seconds, with_tip_ratio
from kerbside.plans import reports
from kerbside.plans.published import FITTED, KEYS, published
from kerbside.sources import (
    fresh_path,
    read_heatmap,
    stored,
    trips_table,
    write_heatmap,
    written_once,
    zones_table,
)

Query = Callable[[SparkSession, str], DataFrame]

# The zone ids the mapping can give, and the hours of a day: pivot columns.
MAPPED_ZONES = range(27)
HOURS = range(24)


def _trips(rules: str) -> Query:
    return lambda spark, tables: clean(trips_table(spark, tables), rules)


timed = _trips("timed")
quality = _trips("quality")
payment = _trips("payment")
carpool = _trips("carpool")
feature = _trips("feature")
model = _trips("model")


def _over(source: Query, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, tables: operator(source(spark, tables))


def _with_zones(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, tables: operator(timed(spark, tables), zones_table(spark, tables))


def _survivors(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.count("*").alias("n"),
        F.sum("trip_distance").alias("sum_distance"),
        F.sum("fare_amount").alias("sum_fare"),
        F.sum(trip_seconds()).alias("sum_seconds"),
    )


def scan_trips(spark: SparkSession, tables: str) -> DataFrame:
    """All rows and columns. The two counts that can be null go out as doubles, because
    clients differ in how they show a null among integers."""
    counts = {name: F.col(name).cast("double") for name in ("passenger_count", "RatecodeID")}
    return trips_table(spark, tables).withColumns(counts)


def heatmap_csv_roundtrip(spark: SparkSession, tables: str) -> DataFrame:
    path = fresh_path(spark, "heatmap")
    write_heatmap(ops.heatmap(timed(spark, tables)), path)
    return read_heatmap(spark, path)


def _published(report: str) -> Query:
    """A report's tables, published and read back, but for the values that a forest gives."""

    def query(spark: SparkSession, tables: str) -> DataFrame:
        trips = trips_table(spark, tables)
        if report == "spatial":
            results = reports.spatial_report(trips, zones_table(spark, tables))
        elif report == "heatmap":
            heat = heatmap_csv_roundtrip(spark, tables)
            results = reports.heatmap_report(heat, zones=MAPPED_ZONES)
        else:
            name = "payments" if report == "results" else report
            results = reports.TRIP_REPORTS[name](trips)
        return published(spark, report, results).filter(~F.col("result_column").isin(*FITTED))

    return query


def enrich_trips(spark: SparkSession, tables: str) -> DataFrame:
    return ops.enrich_trips(quality(spark, tables)).select(
        "pickup_ts",
        "dropoff_ts",
        "trip_distance",
        "fare_amount",
        "passenger_count",
        "trip_duration",
        "average_speed",
        "hour",
        "day_of_week",
        "trip_category",
    )


def feature_table(spark: SparkSession, tables: str) -> DataFrame:
    return ops.feature_table(feature(spark, tables)).select(
        "pickup_ts",
        "PULocationID",
        "DOLocationID",
        "trip_distance",
        "fare_amount",
        "trip_duration",
        "average_speed",
        "tip_percentage",
        "hour",
        "day_of_week",
        "is_peak_hour",
        "trip_category",
        "zone_trip_frequency",
    )


def tip_ratios(trips: DataFrame) -> DataFrame:
    return with_tip_ratio(trips).select("payment_type", "fare_amount", "tip_amount", "tip_ratio")


def heatmap_by_hour(trips: DataFrame) -> DataFrame:
    return ops.heatmap_pivot(ops.heatmap(trips), "hour", "PULocationID", MAPPED_ZONES, "z")


def heatmap_top_n(trips: DataFrame) -> DataFrame:
    """The ranking and the matrix both read the heatmap, so it is stored in between."""
    heat = stored(ops.heatmap(trips), "heatmap")
    return ops.heatmap_pivot(heat, "PULocationID", "hour", HOURS, "h", top_n=15)


def _parts(spark: SparkSession, tables: str) -> tuple[DataFrame, DataFrame]:
    return ops.split(ops.ml_dataset(model(spark, tables)))


def fare_predictions(spark: SparkSession, tables: str) -> DataFrame:
    """The scored test rows: fitted and stored once per application."""

    def write(path: str) -> None:
        train, test = _parts(spark, tables)
        ops.fare_predictions(ops.fit_fare_model(train), test).write.parquet(path)

    return spark.read.parquet(written_once(spark, tables, "fare-predictions", write))


def fare_model_metrics(spark: SparkSession, tables: str) -> DataFrame:
    return ops.fare_model_metrics(fare_predictions(spark, tables), _parts(spark, tables)[0])


def fare_model_checks(spark: SparkSession, tables: str) -> DataFrame:
    return ops.fare_model_checks(fare_predictions(spark, tables), _parts(spark, tables)[0])


def fare_prediction_sample(spark: SparkSession, tables: str) -> DataFrame:
    sample = ops.fare_sample_rows(fare_predictions(spark, tables))
    return sample.select("trip_distance", "total_amount", "prediction")


def fare_test_rows(spark: SparkSession, tables: str) -> DataFrame:
    return fare_predictions(spark, tables).drop("prediction")


def fare_sample_rows(spark: SparkSession, tables: str) -> DataFrame:
    return fare_prediction_sample(spark, tables).drop("prediction")


QUERIES: dict[str, Query] = {
    # sources and sinks
    "scan_trips": scan_trips,
    "zone_lookup": zones_table,
    "heatmap_csv_roundtrip": heatmap_csv_roundtrip,
    **{f"published_{report}": _published(report) for report in KEYS},
    # derived columns and rule sets
    "enrich_trips": enrich_trips,
    "tip_ratios": _over(payment, tip_ratios),
    "feature_table": feature_table,
    "clean_quality": _over(quality, _survivors),
    "clean_payment": _over(payment, _survivors),
    "clean_carpool": _over(carpool, _survivors),
    "clean_feature": _over(feature, _survivors),
    "clean_model": _over(model, _survivors),
    # profile
    "profile_summary": _over(trips_table, lambda t: ops.profile_summary(ops.profile_row(t))),
    "null_profile": _over(trips_table, lambda t: ops.null_profile(ops.profile_row(t))),
    "outlier_counts": _over(trips_table, lambda t: ops.outlier_counts(ops.profile_row(t))),
    # quality
    "trip_category_dist": _over(quality, ops.trip_category_dist),
    "speed_by_hour": _over(quality, ops.speed_by_hour),
    "speed_by_day": _over(quality, ops.speed_by_day),
    "distance_duration_stats": _over(quality, lambda t: ops.distance_duration_stats(t, scale=6)),
    # zones, times, flows
    "top_pickup_zones": _with_zones(ops.top_zones),
    "top_dropoff_zones": _with_zones(lambda t, z: ops.top_zones(t, z, "DOLocationID")),
    "trips_by_hour": _over(timed, ops.trips_by_hour),
    "trips_by_day": _over(timed, ops.trips_by_day),
    "hotspots": _with_zones(ops.hotspots),
    "od_flows": _with_zones(ops.od_flows),
    # payments and tips
    "payment_distribution": _over(payment, ops.payment_distribution),
    "tip_stats": _over(payment, ops.tip_stats),
    "tips_by_hour": _over(payment, ops.tips_by_hour),
    "tips_by_day": _over(payment, ops.tips_by_day),
    "payment_comparison": _over(payment, ops.payment_comparison),
    # carpool
    "carpool_groups": _over(carpool, lambda t: ops.carpool_groups(ops.slot_groups(t))),
    "carpool_summary": _over(carpool, lambda t: ops.carpool_summary(ops.slot_groups(t))),
    "carpool_gains": _over(
        carpool, lambda t: ops.carpool_gains(ops.carpool_groups(ops.slot_groups(t)))
    ),
    # features
    "feature_trips_by_hour": _over(feature, ops.feature_trips_by_hour),
    "revenue_by_hour": _over(feature, ops.revenue_by_hour),
    "anomaly_counts": _over(feature, ops.anomaly_counts),
    "zone_frequency": _over(feature, ops.zone_frequency),
    # heatmap
    "heatmap": _over(timed, ops.heatmap),
    "heatmap_kpis": _over(timed, lambda t: ops.heatmap_kpis(ops.heatmap(t))),
    "heatmap_hourly": _over(timed, lambda t: ops.heatmap_hourly(ops.heatmap(t))),
    "heatmap_top_zones": _over(timed, lambda t: ops.heatmap_top_zones(ops.heatmap(t))),
    "heatmap_by_hour": _over(timed, heatmap_by_hour),
    "heatmap_top_n": _over(timed, heatmap_top_n),
    # fare model
    "ml_dataset": _over(model, ops.ml_dataset),
    "split_counts": _over(model, lambda t: ops.split_counts(ops.ml_dataset(t))),
    "day_index": _over(model, lambda t: ops.day_index(ops.ml_dataset(t))),
    "fare_predictions": fare_predictions,
    "fare_model_metrics": fare_model_metrics,
    "fare_model_checks": fare_model_checks,
    "fare_prediction_sample": fare_prediction_sample,
    "fare_test_rows": fare_test_rows,
    "fare_sample_rows": fare_sample_rows,
}
