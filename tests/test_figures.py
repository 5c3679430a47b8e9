"""Known figures of the mapped trips at two scales."""

import pytest

from kerbside import operators as ops
from kerbside.functions import clean
from kerbside.sources import trips_table

FIGURES = {
    "sf0.001": {
        "trips": 6000,
        "nulls": 536,
        "outliers": (49, 116, 829, 107),
        "quality": 4393,
        "categories": {"long_trip": 966, "short_trip": 3427},
        "feature": 5698,
        "anomalies": (255, 5, 180, 22),
        "carpool": (2137, 214),
        "gains": (220.4, 691.05, 2083.45),
        "model": 5831,
        "cells": 636,
    },
    "sf0.01": {
        "trips": 60000,
        "nulls": 5546,
        "outliers": (635, 1075, 7833, 1181),
        "quality": 44175,
        "categories": {"long_trip": 9740, "short_trip": 34435},
        "feature": 56875,
        "anomalies": (2211, 60, 1611, 242),
        "carpool": (21299, 2974),
        "gains": (3188.7, 10428.68, 29933.94),
        "model": 58179,
        "cells": 648,
    },
}


@pytest.mark.parametrize("scale", sorted(FIGURES))
def test_figures(spark, scale):
    want = FIGURES[scale]
    trips = trips_table(spark, f"/root/testdata/{scale}")
    row = ops.profile_row(trips)
    nulls = {r["column_name"]: r["null_count"] for r in ops.null_profile(row).collect()}
    groups = ops.slot_groups(clean(trips, "carpool"))
    categories = ops.trip_category_dist(clean(trips, "quality")).collect()
    got = {
        "trips": ops.profile_summary(row).first()["n"],
        "nulls": nulls["passenger_count"],
        "outliers": tuple(ops.outlier_counts(row).first()),
        "quality": clean(trips, "quality").count(),
        "categories": {r["trip_category"]: r["n"] for r in categories},
        "feature": clean(trips, "feature").count(),
        "anomalies": tuple(ops.anomaly_counts(clean(trips, "feature")).first()),
        "carpool": tuple(ops.carpool_summary(groups).first()),
        "gains": tuple(ops.carpool_gains(ops.carpool_groups(groups)).first()),
        "model": ops.ml_dataset(clean(trips, "model")).count(),
        "cells": ops.heatmap(clean(trips, "timed")).count(),
    }
    assert got == want
    touched = ("passenger_count", "RatecodeID", "store_and_fwd_flag")
    touched += ("congestion_surcharge", "Airport_fee")
    assert {k: v for k, v in nulls.items() if v} == dict.fromkeys(touched, want["nulls"])
