"""Whole reports: every result of one analysis, from as few passes over the trips as it takes.

A report first stores a tally on the keys its results need between them, at most some
million rows however many trips there are, and rolls each result up from that.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from kerbside import operators as ops
from kerbside.functions import anomaly_flags, clean, with_length_class
from kerbside.sources import stored

Results = dict[str, DataFrame]


def _stored(counts: ops.Tally, name: str) -> ops.Tally:
    return ops.Tally(stored(counts.frame, name))


def profile_report(trips: DataFrame) -> Results:
    """Size, period, nulls and outliers of raw trips: one pass."""
    row = stored(ops.profile_row(trips), "profile")
    return {
        "profile_summary": ops.profile_summary(row),
        "null_profile": ops.null_profile(row),
        "outlier_counts": ops.outlier_counts(row),
    }


def quality_report(trips: DataFrame) -> Results:
    """Distance classes, speeds and statistics: one pass."""
    rows = clean(trips, "quality")
    keys = ["trip_category", "hour", "day_of_week"]
    counts = ops.tally(with_length_class(rows), keys, ["speed"], spreads=ops.described_columns())
    counts = _stored(counts, "quality")
    return {
        "clean_trips": ops.count_all(counts),
        "trip_category_dist": ops.trip_category_dist(counts),
        "speed_by_hour": ops.speed_by_hour(counts),
        "speed_by_day": ops.speed_by_day(counts),
        "distance_duration_stats": ops.distance_duration_stats(counts, scale=6),
    }


def spatial_report(trips: DataFrame, zones: DataFrame) -> Results:
    """Zones, times, hotspots, flows and the heatmap: one pass."""
    keys = ["PULocationID", "DOLocationID", "hour", "day_of_week"]
    counts = _stored(ops.tally(clean(trips, "timed"), keys), "spatial")
    return {
        "trips": ops.count_all(counts),
        "top_pickup_zones": ops.top_zones(counts, zones),
        "top_dropoff_zones": ops.top_zones(counts, zones, "DOLocationID"),
        "trips_by_hour": ops.trips_by_hour(counts),
        "trips_by_day": ops.trips_by_day(counts),
        "hotspots": ops.hotspots(counts, zones),
        "od_flows": ops.od_flows(counts, zones),
        "heatmap": ops.heatmap(counts),
    }


def payment_report(trips: DataFrame) -> Results:
    """Payment types and tips: one pass."""
    keys = ["payment_type", "hour", "day_of_week"]
    measures = ["tip", "tip_ratio", "total", "distance", "speed"]
    counts = _stored(ops.tally(clean(trips, "payment"), keys, measures), "payments")
    return {
        "payment_distribution": ops.payment_distribution(counts),
        "tip_stats": ops.tip_stats(counts),
        "tips_by_hour": ops.tips_by_hour(counts),
        "tips_by_day": ops.tips_by_day(counts),
        "payment_comparison": ops.payment_comparison(counts),
    }


def carpool_report(trips: DataFrame) -> Results:
    """Short trips, shareable groups and savings: one pass."""
    groups = stored(ops.slot_groups(clean(trips, "carpool")), "slot-groups")
    return {
        "carpool_summary": ops.carpool_summary(groups),
        "carpool_gains": ops.carpool_gains(ops.carpool_groups(groups)),
    }


def feature_report(trips: DataFrame) -> Results:
    """Hourly trips and revenue, anomalies and busiest zones: one pass."""
    keys = ["PULocationID", "hour"]
    counts = ops.tally(clean(trips, "feature"), keys, ["total"], anomaly_flags())
    counts = _stored(counts, "features")
    return {
        "trips": ops.count_all(counts),
        "feature_trips_by_hour": ops.feature_trips_by_hour(counts),
        "revenue_by_hour": ops.revenue_by_hour(counts),
        "anomaly_counts": ops.anomaly_counts(counts),
        "zone_frequency": ops.zone_frequency(counts),
    }


def fare_model_report(trips: DataFrame) -> Results:
    """Fit once, score once: metrics, what must hold of a good fit, and a sample of the predictions."""
    rows = stored(ops.ml_dataset(clean(trips, "model")), "model-rows")
    train, test = ops.split(rows)
    model = ops.fit_fare_model(train)
    scored = stored(ops.fare_predictions(model, test), "predictions")
    return {
        "fare_model_metrics": ops.fare_model_metrics(scored, train),
        "fare_model_checks": ops.fare_model_checks(scored, train),
        "fare_prediction_sample": ops.fare_prediction_sample(model, test),
    }


def heatmap_report(
    heat: DataFrame, top_n: int = 15, zones: Sequence[int] | None = None
) -> Results:
    """Figures, roll-ups and both matrices of a heatmap read back from its CSV.

    ``zones`` names the columns of the matrix by hour; without it Spark looks them up.
    """
    return {
        "heatmap_kpis": ops.heatmap_kpis(heat),
        "heatmap_hourly": ops.heatmap_hourly(heat),
        "heatmap_top_zones": ops.heatmap_top_zones(heat),
        "heatmap_by_hour": ops.heatmap_pivot(heat, "hour", "PULocationID", zones, "z"),
        "heatmap_top_n": ops.heatmap_pivot(
            heat, "PULocationID", "hour", range(24), prefix="h", top_n=top_n
        ),
    }


# Reports over the trips alone; the spatial one needs the zones, the heatmap one its CSV.
TRIP_REPORTS: dict[str, Callable[[DataFrame], Results]] = {
    "profile": profile_report,
    "quality": quality_report,
    "payments": payment_report,
    "carpool": carpool_report,
    "features": feature_report,
    "fare_model": fare_model_report,
}
