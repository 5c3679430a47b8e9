"""Zone, time and flow rankings over trips with a pickup time.

Trips are counted and cut to the top rows before the lookup, so the join sees at
most ``k`` rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.core import Trips, count_by, lookup_zone, top_k

PICKUP_ZONE = "PULocationID"
DROPOFF_ZONE = "DOLocationID"


def top_zones(trips: Trips, zones: DataFrame, key: str = PICKUP_ZONE, k: int = 10) -> DataFrame:
    busiest = top_k(count_by(trips, [key]), "n", k, [key])
    named = lookup_zone(busiest, zones, key).orderBy(F.desc("n"), key)
    return named.select(key, "Zone", "Borough", "n")


def trips_by_hour(trips: Trips) -> DataFrame:
    return count_by(trips, ["hour"]).orderBy("hour")


def trips_by_day(trips: Trips) -> DataFrame:
    return count_by(trips, ["day_of_week"]).orderBy(F.desc("n"), "day_of_week")


def hotspots(trips: Trips, zones: DataFrame, k: int = 10) -> DataFrame:
    """The busiest pairs of hour and pickup zone."""
    keys = ["hour", PICKUP_ZONE]
    busiest = top_k(count_by(trips, keys), "n", k, keys)
    named = lookup_zone(busiest, zones, PICKUP_ZONE).orderBy(F.desc("n"), *keys)
    return named.select(*keys, "Zone", "Borough", "n")


def od_flows(trips: Trips, zones: DataFrame, k: int = 10) -> DataFrame:
    """The busiest pairs of origin and destination, both labelled."""
    keys = [PICKUP_ZONE, DROPOFF_ZONE]
    busiest = top_k(count_by(trips, keys), "n", k, keys)
    named = lookup_zone(busiest, zones, PICKUP_ZONE, "PU_")
    named = lookup_zone(named, zones, DROPOFF_ZONE, "DO_").orderBy(F.desc("n"), *keys)
    return named.select(*keys, "n", "PU_Borough", "PU_Zone", "DO_Borough", "DO_Zone")
