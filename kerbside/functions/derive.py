"""Derived trip columns, all built-in expressions."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekday labels, Monday first.
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")

# First and last hour of each peak, both included.
PEAK_SPANS = ((7, 9), (16, 19))


def pickup_time() -> Column:
    return F.col("tpep_pickup_datetime").cast("timestamp_ntz")


def dropoff_time() -> Column:
    return F.col("tpep_dropoff_datetime").cast("timestamp_ntz")


def trip_seconds() -> Column:
    """Whole seconds from pickup to dropoff, each time cut to the second first."""
    return F.unix_timestamp(dropoff_time()) - F.unix_timestamp(pickup_time())


def trip_minutes() -> Column:
    return trip_seconds() / 60


def trip_speed() -> Column:
    """Distance per hour; null where the trip took no time."""
    return F.try_divide(F.col("trip_distance"), trip_minutes() / 60)


def tip_ratio() -> Column:
    """Tip over fare; null without a fare."""
    return F.try_divide(F.col("tip_amount"), F.col("fare_amount"))


def pickup_hour() -> Column:
    return F.hour(pickup_time())


def pickup_weekday() -> Column:
    """``Mon`` to ``Sun``, by wall clock and whatever the session's zone."""
    labels = F.array(*[F.lit(day) for day in WEEKDAYS])
    return F.get(labels, F.weekday(pickup_time().cast("date")))


def with_times(trips: DataFrame) -> DataFrame:
    return trips.withColumns({"pickup_ts": pickup_time(), "dropoff_ts": dropoff_time()})


def with_duration(trips: DataFrame) -> DataFrame:
    """``trip_seconds`` (whole) and ``trip_duration`` in minutes."""
    return trips.withColumns({"trip_seconds": trip_seconds(), "trip_duration": trip_minutes()})


def with_speed(trips: DataFrame) -> DataFrame:
    return trips.withColumn("average_speed", trip_speed())


def with_calendar(trips: DataFrame) -> DataFrame:
    """``hour`` 0 to 23 and ``day_of_week`` of the pickup."""
    return trips.withColumns({"hour": pickup_hour(), "day_of_week": pickup_weekday()})


def with_length_class(
    trips: DataFrame,
    cuts: Sequence[float] = (10,),
    labels: Sequence[str] = ("short_trip", "long_trip"),
    out: str = "trip_category",
) -> DataFrame:
    """Name the distance band; a distance on a cut belongs to the band above it."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("one label more than cuts is needed")
    band = F.when(F.col("trip_distance") < cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:-1]):
        band = band.when(F.col("trip_distance") < cut, label)
    return trips.withColumn(out, band.otherwise(labels[-1]))


def with_tip_ratio(trips: DataFrame, as_percent: bool = False) -> DataFrame:
    """``tip_ratio``, or with ``as_percent`` ``tip_percentage``, 0 where no fare was paid."""
    if not as_percent:
        return trips.withColumn("tip_ratio", tip_ratio())
    percent = F.when(F.col("fare_amount") > 0, tip_ratio() * 100).otherwise(0.0)
    return trips.withColumn("tip_percentage", percent)


def with_peak_hour(trips: DataFrame, spans: Sequence[tuple[int, int]] = PEAK_SPANS) -> DataFrame:
    """``is_peak_hour``: 1 within a span, else 0."""
    inside = F.lit(False)
    for first, last in spans:
        inside = inside | pickup_hour().between(first, last)
    return trips.withColumn("is_peak_hour", F.when(inside, 1).otherwise(0))
