"""Counts, rankings, lookups, statistics, slots, heatmap on hand-made trips."""

import random
import statistics
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from trips import PICKUP, frame, trip

from kerbside import operators as ops


@pytest.fixture(scope="module")
def zones(spark):
    rows = [(1, "North", "Old Town"), (2, "South", "Port"), (None, "East", "Nowhere")]
    return spark.createDataFrame(rows, "LocationID int, Borough string, Zone string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_profile(spark):
    trips = frame(
        spark, [trip(), trip(passenger_count=None, Airport_fee=None), trip(Airport_fee=None)]
    )
    row = ops.profile_row(trips)
    assert rows(ops.profile_summary(row)) == [(3, PICKUP, PICKUP)]
    nulls = dict(rows(ops.null_profile(row)))
    assert list(nulls) == trips.columns
    assert {k: v for k, v in nulls.items() if v} == {"passenger_count": 1, "Airport_fee": 2}


def test_profile_of_no_trips(spark):
    row = ops.profile_row(frame(spark, []))
    assert rows(ops.profile_summary(row)) == [(0, None, None)]
    assert set(dict(rows(ops.null_profile(row))).values()) == {0}


def test_ties_at_the_last_rank_go_to_the_lower_key(spark, zones):
    trips = frame(spark, [trip(PULocationID=z) for z in range(12, 0, -1)] + [trip(PULocationID=7)])
    top = rows(ops.top_zones(trips, zones))
    assert top == [(7, None, None, 2), (1, "Old Town", "North", 1), (2, "Port", "South", 1)] + [
        (z, None, None, 1) for z in (3, 4, 5, 6, 8, 9, 10)
    ]
    assert rows(ops.zone_frequency(trips, 3)) == [(7, 2), (1, 1), (2, 1)]


def test_an_unknown_or_null_zone_keeps_its_row(spark, zones):
    trips = frame(spark, [trip(PULocationID=None), trip(PULocationID=99)])
    assert rows(ops.top_zones(trips, zones)) == [(None, None, None, 1), (99, None, None, 1)]


def test_hotspots_and_flows(spark, zones):
    late = PICKUP + timedelta(hours=2)
    trips = frame(spark, [trip(), trip(), trip(at=late), trip(DOLocationID=9)])
    assert rows(ops.hotspots(trips, zones)) == [
        (8, 1, "Old Town", "North", 3),
        (10, 1, "Old Town", "North", 1),
    ]
    assert rows(ops.od_flows(trips, zones)) == [
        (1, 2, 3, "North", "Old Town", "South", "Port"),
        (1, 9, 1, "North", "Old Town", None, None),
    ]


def test_days_are_ordered_by_count_then_name(spark):
    days = [PICKUP + timedelta(days=d) for d in (0, 0, 1, 2)]
    assert rows(ops.trips_by_day(frame(spark, [trip(at=d) for d in days]))) == [
        ("Mon", 2),
        ("Tue", 1),
        ("Wed", 1),
    ]


def test_tip_percentage_is_a_mean_of_ratios(spark):
    trips = frame(
        spark, [trip(fare_amount=10.0, tip_amount=5.0), trip(fare_amount=100.0, tip_amount=0.0)]
    )
    assert rows(ops.tip_stats(trips)) == [(1, 2.5, 25.0, 5.0)]


def test_speed_is_a_mean_of_speeds(spark):
    trips = frame(
        spark, [trip(minutes=60, trip_distance=10.0), trip(minutes=6, trip_distance=10.0)]
    )
    assert rows(ops.speed_by_hour(trips)) == [(8, 55.0)]


def test_numeric_stats(spark):
    numbers = [1.0, 2.0, 4.5, 10.0]
    df = spark.createDataFrame([(n,) for n in (*numbers, None)], "x double")
    got = {r["summary"]: r["x"] for r in ops.numeric_stats(df, {"x": F.col("x")}).collect()}
    assert list(got) == ["count", "mean", "stddev", "min", "max"]
    assert got["count"] == 4 and got["min"] == 1 and got["max"] == 10
    assert got["mean"] == pytest.approx(statistics.mean(numbers))
    assert got["stddev"] == pytest.approx(statistics.stdev(numbers))


def test_slot_edges_and_group_sizes(spark):
    at = datetime(2025, 3, 3, 0, 9, 59)
    times = [at, at + timedelta(seconds=1), at + timedelta(seconds=600, milliseconds=999)]
    trips = frame(spark, [trip(at=t) for t in times] + [trip(at=at, trip_distance=5.0)])
    groups = ops.slot_groups(trips).orderBy("slot_start")
    assert rows(groups.select("slot_start", "slot_end", "trips_in_group")) == [
        (datetime(2025, 3, 3, 0, 0), datetime(2025, 3, 3, 0, 10), 1),
        (datetime(2025, 3, 3, 0, 10), datetime(2025, 3, 3, 0, 20), 2),
    ]
    assert rows(ops.carpool_summary(groups)) == [(3, 1)]
    assert rows(ops.carpool_gains(ops.carpool_groups(groups))) == [(1.2, 3.0, 2.4)]


def test_carpool_of_no_trips(spark):
    groups = ops.slot_groups(frame(spark, []))
    assert rows(ops.carpool_summary(groups)) == [(0, 0)]
    assert rows(ops.carpool_gains(groups)) == [(None, None, None)]


def test_savings_rates_are_parameters(spark):
    groups = ops.slot_groups(frame(spark, [trip(), trip()]))
    assert rows(ops.carpool_gains(groups, ("0.5", "0.25", "1"))) == [(3.0, 5.0, 24.0)]


def test_slot_groups_against_brute_force(spark):
    pick = random.Random(7)
    made = []
    for _ in range(600):
        at = datetime(2025, 3, 3) + timedelta(seconds=pick.randrange(6 * 3600))
        made.append(
            trip(
                at=at,
                minutes=pick.randrange(1, 90),
                # A third of all trips start in one zone.
                PULocationID=1 if pick.random() < 0.33 else pick.randrange(2, 20),
                trip_distance=pick.randrange(1, 40) / 4,
                fare_amount=pick.randrange(1, 200) / 4,
            )
        )
    index = {name: i for i, name in enumerate(frame(spark, []).columns)}
    expected = defaultdict(lambda: [0, 0.0, 0.0, 0])
    for row in made:
        start, end = row[index["tpep_pickup_datetime"]], row[index["tpep_dropoff_datetime"]]
        if row[index["trip_distance"]] < 5:
            slot = start.replace(minute=start.minute // 10 * 10, second=0)
            group = expected[row[index["PULocationID"]], slot]
            group[0] += 1
            group[1] += row[index["trip_distance"]]
            group[2] += row[index["fare_amount"]]
            group[3] += int((end - start).total_seconds())
    groups = ops.carpool_groups(ops.slot_groups(frame(spark, made)))
    got = {
        (r.PULocationID, r.slot_start): [
            r.trips_in_group, r.total_distance, r.total_fare, r.total_seconds
        ]
        for r in groups.collect()
    }
    assert got == {key: group for key, group in expected.items() if group[0] >= 2}


def test_zone_frequency_counts_every_zone(spark):
    ids = [1, 1, 1, 2, None, None]
    trips = frame(spark, [trip(PULocationID=z) for z in ids])
    expected = Counter((z, ids.count(z)) for z in ids)
    counted = ops.with_zone_frequency(trips)
    assert Counter(rows(counted.select("PULocationID", "zone_trip_frequency"))) == expected


def test_heatmap_figures_and_matrices(spark):
    later = PICKUP + timedelta(hours=1)
    heat = ops.heatmap(
        frame(spark, [trip(), trip(), trip(at=later), trip(PULocationID=4), trip(PULocationID=9)])
    )
    assert rows(ops.heatmap_kpis(heat)) == [(4, 5, 2, 3)]
    assert rows(ops.heatmap_hourly(heat)) == [(8, 4), (9, 1)]
    assert rows(ops.heatmap_top_zones(heat, 2)) == [(1, 3), (4, 1)]
    by_hour = ops.heatmap_pivot(heat, "hour", "PULocationID", [1, 4, 9, 12], "z").orderBy("hour")
    assert by_hour.columns == ["hour", "z1", "z4", "z9", "z12"]
    assert rows(by_hour) == [(8, 2, 1, 1, 0), (9, 1, 0, 0, 0)]
    found = ops.heatmap_pivot(heat, "hour", "PULocationID", prefix="z").orderBy("hour")
    assert rows(found) == [(8, 2, 1, 1), (9, 1, 0, 0)]
    top = ops.heatmap_pivot(heat, "PULocationID", "hour", [8, 9], "h", top_n=2)
    assert sorted(rows(top)) == [(1, 2, 1), (4, 1, 0)]


def test_a_tally_gives_what_the_trips_give(spark):
    trips = frame(
        spark,
        [trip(tip_amount=t, PULocationID=z) for t, z in ((1.0, 1), (None, 1), (4.0, 2), (None, 3))],
    )
    tally = ops.tally(trips, ["PULocationID", "hour"], ["tip"])
    assert rows(ops.tips_by_hour(tally)) == rows(ops.tips_by_hour(trips)) == [(8, 2.5)]
    assert sorted(rows(ops.mean_by(tally, ["PULocationID"], "tip", "m"))) == [
        (1, 1.0),
        (2, 4.0),
        (3, None),
    ]
    assert rows(ops.count_all(tally)) == rows(ops.count_all(trips)) == [(4,)]


def test_a_trip_column_called_n_is_no_count(spark):
    trips = frame(spark, [trip(), trip()]).withColumn("n", F.lit(50))
    assert rows(ops.count_by(trips, ["PULocationID"])) == [(1, 2)]
    other = trips.select("PULocationID", "n")
    assert rows(ops.count_by(other, ["PULocationID"])) == [(1, 2)]
    assert rows(ops.count_by(trips.withColumn("hour", F.lit(3)), ["hour"])) == [(8, 2)]


def test_a_null_zone_takes_no_rank(spark):
    heat = ops.heatmap(frame(spark, [trip(PULocationID=z) for z in [None] * 3 + [*range(1, 17)]]))
    assert len(rows(ops.heatmap_top_zones(heat, 15))) == 15
    assert rows(ops.heatmap_top_zones(heat, 2)) == [(1, 1), (2, 1)]
    assert len(rows(ops.heatmap_pivot(heat, "PULocationID", "hour", [8], "h", top_n=15))) == 15
    named = ops.heatmap_pivot(heat, "hour", "PULocationID", range(1, 17), "z")
    assert named.columns == ops.heatmap_pivot(heat, "hour", "PULocationID", prefix="z").columns


def test_statistics_of_a_tally(spark):
    made = [trip(trip_distance=d / 7, at=PICKUP + timedelta(hours=d % 5)) for d in range(1, 90)]
    trips = frame(spark, made)
    columns = {"x": F.col("trip_distance")}
    for part in (trips, trips.limit(1), trips.limit(0)):
        tally = ops.tally(part, ["hour"], spreads=columns)
        assert rows(ops.numeric_stats(tally, columns, 9)) == rows(ops.numeric_stats(part, columns, 9))
