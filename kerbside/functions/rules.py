"""Named cleaning rule sets.

The sets differ on purpose and are not to be unified: each analysis keeps its own
rows. A row passes when every predicate is true, so a null in a tested column drops
it. Predicates stand on raw columns wherever they can, to reach the parquet scan.
"""

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.derive import (
    dropoff_time,
    pickup_time,
    trip_minutes,
    trip_seconds,
    trip_speed,
)

# Fixed value: a trip must be shorter than this, in minutes.
MAX_MINUTES = 300


def has_pickup() -> list[Column]:
    return [F.col("tpep_pickup_datetime").isNotNull()]


def has_times() -> list[Column]:
    return [*has_pickup(), F.col("tpep_dropoff_datetime").isNotNull()]


def plausible_duration(max_minutes: int = MAX_MINUTES) -> list[Column]:
    return [trip_seconds() > 0, trip_seconds() < max_minutes * 60]


def quality_rules() -> list[Column]:
    return [
        *has_times(),
        F.col("trip_distance") > 0,
        F.col("fare_amount") >= 0,
        F.col("passenger_count") > 0,
        dropoff_time() > pickup_time(),
        *plausible_duration(),
    ]


def payment_rules() -> list[Column]:
    return [
        *has_times(),
        F.col("fare_amount") > 0,
        F.col("total_amount") >= 0,
        F.col("trip_distance") > 0,
        *plausible_duration(),
    ]


def carpool_rules() -> list[Column]:
    return [
        *has_times(),
        F.col("trip_distance") > 0,
        F.col("fare_amount") > 0,
        *plausible_duration(),
    ]


def feature_rules() -> list[Column]:
    return [
        *has_times(),
        F.col("trip_distance") > 0,
        F.col("fare_amount") >= 0,
        *plausible_duration(),
    ]


def model_rules(max_total: float = 200, max_distance: float = 50) -> list[Column]:
    return [
        F.col("total_amount") > 0,
        F.col("total_amount") < max_total,
        F.col("trip_distance") > 0,
        F.col("trip_distance") < max_distance,
    ]


RULE_SETS: dict[str, Callable[[], list[Column]]] = {
    "timed": has_pickup,
    "quality": quality_rules,
    "payment": payment_rules,
    "carpool": carpool_rules,
    "feature": feature_rules,
    "model": model_rules,
}


def clean(trips: DataFrame, rules: str | list[Column]) -> DataFrame:
    """The rows that pass every predicate of a named set, or of a list given."""
    if isinstance(rules, str):
        if rules not in RULE_SETS:
            raise ValueError(f"no rule set {rules!r}; there are {', '.join(RULE_SETS)}")
        rules = RULE_SETS[rules]()
    return trips.filter(reduce(and_, rules))


def outlier_flags() -> dict[str, Column]:
    """What profiling counts on raw trips; a null is no outlier."""
    return {
        "invalid_distance": F.col("trip_distance") <= 0,
        "negative_fare": F.col("fare_amount") < 0,
        "invalid_passengers": F.col("passenger_count") <= 0,
        "invalid_dates": F.col("tpep_dropoff_datetime") <= F.col("tpep_pickup_datetime"),
    }


def anomaly_flags() -> dict[str, Column]:
    """What the feature analysis counts on feature-clean trips."""
    return {
        "very_short": F.col("trip_distance") <= 0.5,
        "very_long": F.col("trip_distance") >= 50,
        "too_fast": trip_speed() > 120,
        "too_lengthy": trip_minutes() > 180,
    }
