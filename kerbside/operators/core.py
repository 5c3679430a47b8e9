"""Grouped counts and means, conditional counts, statistics, top-k, zone labels.

The grouped operators take trips, or a ``Tally`` of trips: one row per key combination
with the row count ``n`` and, per measure, its sum and the number of values summed.
A tally is small and can be rolled up to fewer keys, so one pass over the trips
serves every result of a report.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.derive import pickup_hour, pickup_weekday, tip_ratio, trip_speed

DERIVED_KEYS: dict[str, Callable[[], Column]] = {
    "hour": pickup_hour,
    "day_of_week": pickup_weekday,
}

MEASURES: dict[str, Callable[[], Column]] = {
    "distance": lambda: F.col("trip_distance"),
    "speed": trip_speed,
    "tip": lambda: F.col("tip_amount"),
    "tip_ratio": tip_ratio,
    "total": lambda: F.col("total_amount"),
}


@dataclass(frozen=True)
class Tally:
    """Rows that stand for ``n`` trips each."""

    frame: DataFrame


Trips = DataFrame | Tally


def with_keys(trips: Trips, keys: Sequence[str], derive: bool = True) -> DataFrame:
    """Trips with their calendar keys derived; a tally's rows as they are, and so are rows that
    hold their keys already (``derive=False``)."""
    if isinstance(trips, Tally):
        return trips.frame
    derived = {key: DERIVED_KEYS[key]() for key in keys if key in DERIVED_KEYS}
    return trips.withColumns(derived) if derived and derive else trips


def tally(
    trips: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str] = (),
    flags: Mapping[str, Column] | None = None,
    spreads: Mapping[str, Column] | None = None,
) -> Tally:
    """Count, sum and flag counts per key combination, and of ``spreads`` what it takes to
    merge statistics: count, mean, squared deviations, least and greatest."""
    parts = [F.count("*").alias("n")]
    for name in measures:
        value = MEASURES[name]()
        parts += [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_count")]
    parts += [F.count_if(flag).alias(name) for name, flag in (flags or {}).items()]
    for name, value in (spreads or {}).items():
        count = F.count(value)
        parts += [
            count.alias(f"{name}_values"),
            F.avg(value).alias(f"{name}_mean"),
            (F.var_pop(value) * count).alias(f"{name}_squares"),
            F.min(value).alias(f"{name}_min"),
            F.max(value).alias(f"{name}_max"),
        ]
    return Tally(with_keys(trips, keys).groupBy(*keys).agg(*parts))


def row_count(trips: Trips) -> Column:
    """Aggregate: trips in the group."""
    return F.sum("n") if isinstance(trips, Tally) else F.count("*")


def sum_of(trips: Trips, measure: str) -> Column:
    """Aggregate: sum of a measure."""
    return F.sum(f"{measure}_sum") if isinstance(trips, Tally) else F.sum(MEASURES[measure]())


def mean_of(trips: Trips, measure: str) -> Column:
    """Aggregate: mean of a measure over the trips that have it."""
    if isinstance(trips, Tally):
        return F.try_divide(F.sum(f"{measure}_sum"), F.sum(f"{measure}_count"))
    return F.avg(MEASURES[measure]())


def count_all(trips: Trips) -> DataFrame:
    """One row: ``n``, 0 where there are no trips."""
    return with_keys(trips, ()).agg(F.coalesce(row_count(trips), F.lit(0)).alias("n"))


def count_by(trips: Trips, keys: Sequence[str], derive: bool = True) -> DataFrame:
    """Keys and ``n``."""
    return with_keys(trips, keys, derive).groupBy(*keys).agg(row_count(trips).alias("n"))


def mean_by(
    trips: Trips, keys: Sequence[str], measure: str, out: str, scale: int = 2
) -> DataFrame:
    """Keys and the rounded mean of a measure."""
    mean = F.round(mean_of(trips, measure), scale)
    return with_keys(trips, keys).groupBy(*keys).agg(mean.alias(out))


def count_flags(trips: Trips, flags: Mapping[str, Column]) -> DataFrame:
    """One row, one count per flag, all in one pass."""
    counts = [
        F.coalesce(F.sum(name), F.lit(0)) if isinstance(trips, Tally) else F.count_if(flag)
        for name, flag in flags.items()
    ]
    return with_keys(trips, ()).agg(*[count.alias(name) for name, count in zip(flags, counts)])


def numeric_stats(
    trips: Trips, columns: Mapping[str, Column], scale: int | None = None
) -> DataFrame:
    """``summary`` (count, mean, stddev, min, max) by column, in one pass.

    All figures are doubles; ``stddev`` is the sample deviation. ``scale`` rounds the
    two whose last digits depend on the order of addition. A tally needs the columns among
    its ``spreads``.
    """

    def cut(value: Column) -> Column:
        return value if scale is None else F.round(value, scale)

    def figures(name: str, value: Column) -> dict[str, Column]:
        if isinstance(trips, Tally):
            count = F.sum(f"{name}_values")
            weighted = F.col(f"{name}_values") * F.col(f"{name}_mean")
            mean = F.try_divide(F.sum(weighted), count)
            squares = F.sum(F.col(f"{name}_squares") + weighted * F.col(f"{name}_mean"))
            spread = F.greatest(squares - count * mean * mean, F.lit(0.0))
            deviation = F.sqrt(F.when(count > 1, spread / (count - 1)))
            count = F.coalesce(count, F.lit(0))
            least, most = F.min(f"{name}_min"), F.max(f"{name}_max")
        else:
            count, mean, deviation = F.count(value), F.avg(value), F.stddev_samp(value)
            least, most = F.min(value), F.max(value)
        return {
            "count": count.cast("double"),
            "mean": cut(mean),
            "stddev": cut(deviation),
            "min": least.cast("double"),
            "max": most.cast("double"),
        }

    by_column = {name: figures(name, value) for name, value in columns.items()}
    labels = ["count", "mean", "stddev", "min", "max"]
    one_row = with_keys(trips, ()).agg(
        *[by_column[name][label].alias(f"{name}_{label}") for name in columns for label in labels]
    )
    lines = [
        F.struct(
            F.lit(label).alias("summary"),
            *[F.col(f"{name}_{label}").alias(name) for name in columns],
        )
        for label in labels
    ]
    return one_row.select(F.inline(F.array(*lines)))


def top_k(df: DataFrame, by: str, k: int = 10, ties: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows largest in ``by``; ``ties`` order equal ones and make it repeatable."""
    return df.orderBy(F.desc(by), *ties).limit(k)


def lookup_zone(df: DataFrame, zones: DataFrame, key: str, prefix: str = "") -> DataFrame:
    """Add ``Zone`` and ``Borough`` of the zone in ``key``; null where it is unknown.

    No broadcast hint: the session's size threshold decides.
    """
    labels = zones.select(
        F.col("LocationID").alias(key),
        F.col("Zone").alias(f"{prefix}Zone"),
        F.col("Borough").alias(f"{prefix}Borough"),
    )
    return df.join(labels, key, "left")
