"""Payment and tip results over payment-clean trips."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.core import Trips, count_by, mean_by, mean_of, sum_of, with_keys


def payment_distribution(trips: Trips) -> DataFrame:
    return count_by(trips, ["payment_type"]).orderBy(F.desc("n"), "payment_type")


def tip_stats(trips: Trips) -> DataFrame:
    """Tips by payment type. The percentage is a mean of ratios, not a ratio of sums."""
    return with_keys(trips, ()).groupBy("payment_type").agg(
        F.round(mean_of(trips, "tip"), 2).alias("avg_tip"),
        F.round(mean_of(trips, "tip_ratio") * 100, 2).alias("avg_tip_percent"),
        F.round(sum_of(trips, "tip"), 2).alias("total_tips"),
    )


def tips_by_hour(trips: Trips) -> DataFrame:
    return mean_by(trips, ["hour"], "tip", "avg_tip").orderBy("hour")


def tips_by_day(trips: Trips) -> DataFrame:
    by_day = mean_by(trips, ["day_of_week"], "tip", "avg_tip")
    return by_day.orderBy(F.desc("avg_tip"), "day_of_week")


def payment_comparison(trips: Trips) -> DataFrame:
    return with_keys(trips, ()).groupBy("payment_type").agg(
        F.round(mean_of(trips, "total"), 2).alias("avg_total_amount"),
        F.round(mean_of(trips, "distance"), 2).alias("avg_distance"),
        F.round(mean_of(trips, "speed"), 2).alias("avg_speed"),
    )
