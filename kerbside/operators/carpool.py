"""Shareable short trips: same pickup zone, same time slot."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.derive import pickup_time, trip_seconds

# Shares saved of distance, fare and time.
SAVING_RATES = ("0.20", "0.15", "0.10")


def slot_groups(trips: DataFrame, slot: str = "10 minutes", max_distance: float = 5) -> DataFrame:
    """Short trips summed by pickup zone and slot, lone trips included.

    Slots are aligned to the epoch and take their start but not their end. Grouping is
    on the start alone; the end follows from it. Sums are combined before the shuffle,
    so a busy zone and slot arrives as one row per task.
    """
    start = F.window(pickup_time(), slot)["start"]
    groups = (
        trips.filter(F.col("trip_distance") < max_distance)
        .withColumns({"slot_start": start, "trip_seconds": trip_seconds()})
        .groupBy("PULocationID", "slot_start")
        .agg(
            F.count("*").alias("trips_in_group"),
            F.sum("trip_distance").alias("total_distance"),
            F.sum("fare_amount").alias("total_fare"),
            F.sum("trip_seconds").alias("total_seconds"),
        )
    )
    return groups.select(
        "PULocationID",
        "slot_start",
        (F.col("slot_start") + F.expr(f"INTERVAL {slot}")).alias("slot_end"),
        "trips_in_group",
        "total_distance",
        "total_fare",
        "total_seconds",
        (F.col("total_seconds") / 60).alias("total_duration"),
    )


def carpool_groups(groups: DataFrame, min_trips: int = 2) -> DataFrame:
    """The slot groups that could share a ride."""
    return groups.filter(F.col("trips_in_group") >= min_trips)


def carpool_summary(groups: DataFrame, min_trips: int = 2) -> DataFrame:
    """Short trips and shareable groups, both from all slot groups in one pass."""
    return groups.agg(
        F.coalesce(F.sum("trips_in_group"), F.lit(0)).alias("short_trips"),
        F.count_if(F.col("trips_in_group") >= min_trips).alias("carpool_groups"),
    )


def carpool_gains(groups: DataFrame, rates: Sequence[str] = SAVING_RATES) -> DataFrame:
    """Distance, fare and minutes saved over all shareable groups.

    The totals are brought to decimals before the rate is applied, so the second
    decimal does not depend on how the rows were spread.
    """

    def saved(total: Column, rate: str, unit: int = 1) -> Column:
        share = total.cast("decimal(28,6)") * F.lit(rate).cast("decimal(3,2)") / unit
        return F.round(share.cast("decimal(28,6)"), 2).cast("double")

    distance, fare, time = rates
    return groups.agg(
        saved(F.sum("total_distance"), distance).alias("distance_saved"),
        saved(F.sum("total_fare"), fare).alias("fare_saved"),
        saved(F.sum("total_seconds"), time, 60).alias("time_saved"),
    )
