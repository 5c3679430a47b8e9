"""Features and figures over feature-clean trips."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.derive import (
    with_calendar,
    with_duration,
    with_length_class,
    with_peak_hour,
    with_speed,
    with_times,
    with_tip_ratio,
)
from kerbside.functions.rules import anomaly_flags
from kerbside.operators.core import Trips, count_by, count_flags, sum_of, top_k, with_keys
from kerbside.sources.shared import stored

def with_zone_frequency(trips: DataFrame, key: str = "PULocationID") -> DataFrame:
    """``zone_trip_frequency``: how many of the trips start in the trip's zone.

    A window over the zone would put a whole zone into one task. Instead the counts,
    combined before their shuffle, are stored and joined back. Both sides are plain scans:
    Spark knows the counts' size and broadcasts them within the session's threshold, or
    shuffles, and then adaptive execution can split hot zones. Counting runs when this is
    called.
    """
    counts = stored(count_by(trips, [key]), "zone-counts")
    without_zone = counts.agg(F.max(F.when(F.col(key).isNull(), F.col("n")))).first()[0]
    counts = counts.withColumnRenamed("n", "zone_trip_frequency")
    counted = trips.join(counts, key, "left")
    # A null key joins nothing: its count goes in as a value, and the join stays on a plain id.
    frequency = F.coalesce("zone_trip_frequency", F.lit(without_zone).cast("bigint"))
    return counted.select(*trips.columns, frequency.alias("zone_trip_frequency"))


def feature_table(trips: DataFrame) -> DataFrame:
    """Trips with every feature: duration, speed, tip percentage, calendar, peak hour,
    three-way distance class and zone frequency."""
    trips = with_calendar(with_speed(with_duration(with_times(with_zone_frequency(trips)))))
    trips = with_peak_hour(with_tip_ratio(trips, as_percent=True))
    return with_length_class(trips, (2, 10), ("short", "medium", "long"))


def feature_trips_by_hour(trips: Trips) -> DataFrame:
    return count_by(trips, ["hour"]).orderBy("hour")


def revenue_by_hour(trips: Trips) -> DataFrame:
    revenue = F.round(sum_of(trips, "total"), 2)
    return with_keys(trips, ["hour"]).groupBy("hour").agg(revenue.alias("revenue")).orderBy("hour")


def anomaly_counts(trips: Trips) -> DataFrame:
    return count_flags(trips, anomaly_flags())


def zone_frequency(trips: Trips, k: int = 10) -> DataFrame:
    """The ``k`` pickup zones with most trips."""
    return top_k(count_by(trips, ["PULocationID"]), "n", k, ["PULocationID"])
