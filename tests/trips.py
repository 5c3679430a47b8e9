"""Hand-made trips: a plain good trip, changed where a test says so."""

from datetime import datetime, timedelta

from kerbside.sources import TRIP_SCHEMA

PICKUP = datetime(2025, 3, 3, 8, 0, 0)  # a Monday

GOOD = {
    "VendorID": 1,
    "tpep_pickup_datetime": PICKUP,
    "tpep_dropoff_datetime": PICKUP + timedelta(minutes=12),
    "passenger_count": 1,
    "trip_distance": 3.0,
    "RatecodeID": 1,
    "store_and_fwd_flag": "N",
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 10.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 13.5,
    "congestion_surcharge": 2.5,
    "Airport_fee": 0.0,
    "cbd_congestion_fee": 0.75,
}


def trip(minutes=None, at=None, **changes):
    """One row. ``at`` moves the pickup, ``minutes`` sets how long after it the dropoff is."""
    row = dict(GOOD)
    if at is not None:
        row["tpep_pickup_datetime"] = at
        row["tpep_dropoff_datetime"] = at + timedelta(minutes=12)
    if minutes is not None:
        row["tpep_dropoff_datetime"] = row["tpep_pickup_datetime"] + timedelta(minutes=minutes)
    row.update(changes)
    return tuple(row[name] for name in TRIP_SCHEMA.fieldNames())


def frame(spark, rows):
    return spark.createDataFrame(rows, TRIP_SCHEMA)
