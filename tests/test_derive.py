from datetime import datetime, timedelta

import pytest
from trips import PICKUP, frame, trip

from kerbside.functions import (
    with_calendar,
    with_duration,
    with_length_class,
    with_peak_hour,
    with_speed,
    with_times,
    with_tip_ratio,
)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_duration_cuts_to_seconds(spark):
    late = PICKUP + timedelta(milliseconds=900)
    trips = frame(
        spark, [trip(at=late, tpep_dropoff_datetime=PICKUP + timedelta(seconds=61)), trip(minutes=5)]
    )
    assert values(with_duration(trips), "trip_seconds", "trip_duration") == [
        (61, 61 / 60),
        (300, 5.0),
    ]


def test_speed(spark):
    trips = frame(spark, [trip(minutes=30, trip_distance=10.0), trip(minutes=0)])
    assert values(with_speed(trips), "average_speed") == [(20.0,), (None,)]


def test_calendar_is_wall_clock_through_the_hour_that_daylight_saving_skips(spark):
    days = [datetime(2025, 3, 3 + i, 23, 59, 59) for i in range(7)]
    skipped = datetime(2025, 3, 9, 2, 30)
    rows = values(
        with_calendar(frame(spark, [trip(at=d) for d in (*days, skipped)])), "hour", "day_of_week"
    )
    assert [day for _, day in rows[:7]] == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert rows[7] == (2, "Sun")
    across = trip(at=datetime(2025, 3, 9, 1, 50), minutes=80)
    assert values(with_duration(frame(spark, [across])), "trip_seconds") == [(4800,)]


def test_times_keep_their_type(spark):
    timed = with_times(frame(spark, [trip()]))
    assert dict(timed.dtypes)["pickup_ts"] == dict(timed.dtypes)["dropoff_ts"] == "timestamp_ntz"
    assert timed.first()["pickup_ts"] == PICKUP


@pytest.mark.parametrize("distance, two, three", [
    (1.99, "short_trip", "short"),
    (2.0, "short_trip", "medium"),
    (9.99, "short_trip", "medium"),
    (10.0, "long_trip", "long"),
    (None, "long_trip", "long"),
])
def test_length_class(spark, distance, two, three):
    trips = frame(spark, [trip(trip_distance=distance)])
    assert values(with_length_class(trips), "trip_category") == [(two,)]
    wide = with_length_class(trips, (2, 10), ("short", "medium", "long"), out="band")
    assert values(wide, "band") == [(three,)]


def test_length_class_needs_matching_labels(spark):
    with pytest.raises(ValueError):
        with_length_class(frame(spark, []), (2, 10))


def test_tip_ratio(spark):
    trips = frame(spark, [trip(), trip(fare_amount=0.0), trip(fare_amount=-5.0)])
    assert values(with_tip_ratio(trips), "tip_ratio") == [(0.2,), (None,), (-0.4,)]
    percent = values(with_tip_ratio(trips, as_percent=True), "tip_percentage")
    assert percent == [(20.0,), (0.0,), (0.0,)]


def test_peak_hours(spark):
    trips = frame(spark, [trip(at=datetime(2025, 3, 3, h, 30)) for h in range(24)])
    peaks = [h for h, (peak,) in enumerate(values(with_peak_hour(trips), "is_peak_hour")) if peak]
    assert peaks == [7, 8, 9, 16, 17, 18, 19]
    assert values(with_peak_hour(trips, [(0, 0)]), "is_peak_hour")[0] == (1,)
