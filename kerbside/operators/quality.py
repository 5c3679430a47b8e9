"""Results over quality-clean trips."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.derive import (
    trip_minutes,
    with_calendar,
    with_duration,
    with_length_class,
    with_speed,
    with_times,
)
from kerbside.operators.core import Tally, Trips, count_by, mean_by, numeric_stats


def enrich_trips(trips: DataFrame) -> DataFrame:
    """Times, duration, speed, calendar and the two-way distance class."""
    return with_length_class(with_calendar(with_speed(with_duration(with_times(trips)))))


def trip_category_dist(trips: Trips) -> DataFrame:
    if not isinstance(trips, Tally):
        trips = with_length_class(trips)
    return count_by(trips, ["trip_category"])


def speed_by_hour(trips: Trips) -> DataFrame:
    """Mean of the trips' speeds, not of distance over time."""
    return mean_by(trips, ["hour"], "speed", "avg_speed_kmh").orderBy("hour")


def speed_by_day(trips: Trips) -> DataFrame:
    return mean_by(trips, ["day_of_week"], "speed", "avg_speed_kmh")


def described_columns() -> dict[str, Column]:
    return {"trip_distance": F.col("trip_distance"), "trip_duration": trip_minutes()}


def distance_duration_stats(trips: Trips, scale: int | None = None) -> DataFrame:
    return numeric_stats(trips, described_columns(), scale)
