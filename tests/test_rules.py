"""Each rule set at its bounds."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from trips import PICKUP, frame, trip

from kerbside.functions import anomaly_flags, clean, outlier_flags
from kerbside.operators import count_flags

ALL = {"quality", "payment", "carpool", "feature", "model", "timed"}
TIMED_RULES = {"quality", "payment", "carpool", "feature"}

# What changes in a good trip, and the rule sets that still keep it.
CASES = {
    "good": (trip(), ALL),
    "no distance": (trip(trip_distance=0.0), {"timed"}),
    "just some distance": (trip(trip_distance=0.01), ALL),
    "no fare": (trip(fare_amount=0.0), ALL - {"payment", "carpool"}),
    "negative fare": (trip(fare_amount=-0.01), {"model", "timed"}),
    "no passengers": (trip(passenger_count=0), ALL - {"quality"}),
    "null passengers": (trip(passenger_count=None), ALL - {"quality"}),
    "no time": (trip(minutes=0), {"model", "timed"}),
    "backwards": (trip(minutes=-1), {"model", "timed"}),
    "half a second, same second": (
        trip(tpep_dropoff_datetime=PICKUP + timedelta(milliseconds=500)),
        {"model", "timed"},
    ),
    "one second": (trip(tpep_dropoff_datetime=PICKUP + timedelta(seconds=1)), ALL),
    "299 minutes 59 seconds": (
        trip(tpep_dropoff_datetime=PICKUP + timedelta(seconds=17999)),
        ALL,
    ),
    "300 minutes": (trip(minutes=300), {"model", "timed"}),
    "total 0": (trip(total_amount=0.0), ALL - {"model"}),
    "negative total": (trip(total_amount=-0.01), ALL - {"model", "payment"}),
    "total 199.99": (trip(total_amount=199.99), ALL),
    "total 200": (trip(total_amount=200.0), ALL - {"model"}),
    "distance 49.99": (trip(trip_distance=49.99), ALL),
    "distance 50": (trip(trip_distance=50.0), ALL - {"model"}),
    "null pickup": (trip(tpep_pickup_datetime=None), {"model"}),
    "null dropoff": (trip(tpep_dropoff_datetime=None), {"model", "timed"}),
}


@pytest.mark.parametrize("rules", sorted(ALL))
def test_rule_set(spark, rules):
    names = list(CASES)
    rows = [(*row, name) for name, (row, _) in CASES.items()]
    schema = frame(spark, []).schema.add("case", "string")
    kept = {r["case"] for r in clean(spark.createDataFrame(rows, schema), rules).collect()}
    assert kept == {name for name in names if rules in CASES[name][1]}


def test_own_rules(spark):
    trips = frame(spark, [trip(trip_distance=d) for d in (1.0, 2.0, 3.0)])
    assert clean(trips, [F.col("trip_distance") > 1, F.col("trip_distance") < 3]).count() == 1


def test_unknown_rules(spark):
    with pytest.raises(ValueError, match="quality"):
        clean(frame(spark, []), "qualty")


def test_outliers_ignore_nulls(spark):
    trips = frame(
        spark,
        [
            trip(trip_distance=0.0, fare_amount=0.0),
            trip(trip_distance=-1.0, fare_amount=-0.01),
            trip(passenger_count=None, minutes=0),
            trip(passenger_count=0, minutes=-1),
            trip(tpep_dropoff_datetime=None),
        ],
    )
    assert count_flags(trips, outlier_flags()).first().asDict() == {
        "invalid_distance": 2,
        "negative_fare": 1,
        "invalid_passengers": 1,
        "invalid_dates": 2,
    }


def test_anomalies_at_their_bounds(spark):
    trips = frame(
        spark,
        [
            trip(trip_distance=0.5),
            trip(trip_distance=0.51),
            trip(trip_distance=50.0, minutes=30),
            trip(trip_distance=49.99, minutes=30),
            trip(trip_distance=20.0, minutes=10),  # exactly 120 an hour
            trip(trip_distance=20.01, minutes=10),
            trip(minutes=180),
            trip(minutes=181),
        ],
    )
    assert count_flags(trips, anomaly_flags()).first().asDict() == {
        "very_short": 1,
        "very_long": 1,
        "too_fast": 1,
        "too_lengthy": 1,
    }


def test_flags_of_no_trips_are_zero(spark):
    assert set(count_flags(frame(spark, []), outlier_flags()).first()) == {0}
