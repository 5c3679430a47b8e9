"""The zone-by-hour heatmap, its figures, roll-ups and pivots.

A cell without a zone counts in the figures; rankings and matrices leave it out, before any cut.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.core import Tally, Trips, count_by, top_k


def heatmap(trips: Trips) -> DataFrame:
    """``PULocationID``, ``hour`` and ``n`` for every pair that occurs."""
    return count_by(trips, ["PULocationID", "hour"])


def heatmap_kpis(heat: DataFrame) -> DataFrame:
    """Cells, trips, and the hours and zones covered."""
    return heat.agg(
        F.count("*").alias("cells"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("trips"),
        F.countDistinct("hour").alias("hours"),
        F.countDistinct("PULocationID").alias("zones"),
    )


def heatmap_hourly(heat: DataFrame) -> DataFrame:
    return count_by(Tally(heat), ["hour"]).orderBy("hour")


def heatmap_top_zones(heat: DataFrame, k: int = 15) -> DataFrame:
    return busiest(heat, "PULocationID", k)


def busiest(heat: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` keys with most trips, and ``n``."""
    known = heat.filter(F.col(key).isNotNull())
    return top_k(count_by(Tally(known), [key]), "n", k, [key])


def keep_busiest(heat: DataFrame, key: str, n: int) -> DataFrame:
    """The cells whose ``key`` is among the ``n`` with most trips."""
    return heat.join(busiest(heat, key, n).select(key), key, "left_semi")


def heatmap_pivot(
    heat: DataFrame,
    rows: str,
    columns: str,
    values: Sequence[int] | None = None,
    prefix: str = "",
    top_n: int | None = None,
) -> DataFrame:
    """Trips as a matrix, 0 where a pair does not occur.

    ``values`` names the columns and saves the job that would look them up; without it
    Spark finds them, within its own limit. ``prefix`` goes before each column name.
    ``top_n`` keeps the busiest of the row keys.
    """
    heat = heat.filter(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    if top_n is not None:
        heat = keep_busiest(heat, rows, top_n)
    pivot = heat.groupBy(rows).pivot(columns, None if values is None else list(values)).sum("n")
    cells = [name for name in pivot.columns if name != rows]
    return pivot.select(
        rows, *[F.coalesce(F.col(f"`{name}`"), F.lit(0)).alias(f"{prefix}{name}") for name in cells]
    )
