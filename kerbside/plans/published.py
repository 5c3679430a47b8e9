"""Reports published as tables and read back whole, and the same in SQL.

Each result goes out as one long table: result, key, column, value.
"""

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.sources import fresh_path, write_results

# Every published result with the columns that name a row; the others are values.
KEYS: dict[str, dict[str, tuple[str, ...]]] = {
    "profile": {
        "profile_summary": ("period_start", "period_end"),
        "null_profile": ("column_name",),
        "outlier_counts": (),
    },
    "quality": {
        "clean_trips": (),
        "trip_category_dist": ("trip_category",),
        "speed_by_hour": ("hour",),
        "speed_by_day": ("day_of_week",),
        "distance_duration_stats": ("summary",),
    },
    "spatial": {
        "trips": (),
        "top_pickup_zones": ("PULocationID", "Zone", "Borough"),
        "top_dropoff_zones": ("DOLocationID", "Zone", "Borough"),
        "trips_by_hour": ("hour",),
        "trips_by_day": ("day_of_week",),
        "hotspots": ("hour", "PULocationID", "Zone", "Borough"),
        "od_flows": (
            "PULocationID", "DOLocationID", "PU_Borough", "PU_Zone", "DO_Borough", "DO_Zone",
        ),
        "heatmap": ("PULocationID", "hour"),
    },
    "results": {
        "payment_distribution": ("payment_type",),
        "tip_stats": ("payment_type",),
        "tips_by_hour": ("hour",),
        "tips_by_day": ("day_of_week",),
        "payment_comparison": ("payment_type",),
    },
    "carpool": {"carpool_summary": (), "carpool_gains": ()},
    "features": {
        "trips": (),
        "feature_trips_by_hour": ("hour",),
        "revenue_by_hour": ("hour",),
        "anomaly_counts": (),
        "zone_frequency": ("PULocationID",),
    },
    "fare_model": {
        "fare_model_metrics": (),
        "fare_model_checks": (),
        "fare_prediction_sample": (),
    },
    "heatmap": {
        "heatmap_kpis": (),
        "heatmap_hourly": ("hour",),
        "heatmap_top_zones": ("PULocationID",),
        "heatmap_by_hour": ("hour",),
        "heatmap_top_n": ("PULocationID",),
    },
}
# Columns whose values only the fitted forest gives: they are published, but no SQL states them.
FITTED = ("rmse", "r2", "prediction")


def _long(frame: DataFrame, result: str, keys: tuple[str, ...]) -> DataFrame:
    cells = [
        F.struct(
            F.lit(name).alias("result_column"), F.col(name).cast("double").alias("result_value")
        )
        for name in frame.columns
        if name not in keys
    ]
    key = F.concat_ws("|", *[F.col(name).cast("string") for name in keys])
    return frame.select(
        F.lit(result).alias("result"), key.alias("result_key"), F.inline(F.array(*cells))
    )


def published(
    spark: SparkSession, report: str, results: Mapping[str, DataFrame]
) -> DataFrame:
    """All tables of a report, written and read back, as one long table."""
    if set(results) != set(KEYS[report]):
        raise ValueError(f"results of {report} without keys: {set(results) ^ set(KEYS[report])}")
    out = fresh_path(spark, f"published-{report}")
    write_results(results, out)
    back = [
        _long(spark.read.schema(frame.schema).parquet(f"{out}/{name}"), name, KEYS[report][name])
        for name, frame in results.items()
    ]
    every = back[0]
    for frame in back[1:]:
        every = every.unionAll(frame)
    return every


def published_sql(report: str, sql: Callable[[str], tuple[str, list[str]]]) -> str:
    """The same from each result's own SQL and column names, which ``sql`` gives."""
    parts = []
    for result, keys in KEYS[report].items():
        query, columns = sql(result)
        key = ", ".join(f"CAST({name} AS VARCHAR)" for name in keys)
        key = f"concat_ws('|', {key})" if keys else "''"
        for name in columns:
            if name not in keys:
                parts.append(
                    f"SELECT '{result}' AS result, {key} AS result_key, '{name}' AS result_column, "
                    f"CAST({name} AS DOUBLE) AS result_value FROM ({query})"
                )
    return "\nUNION ALL ".join(parts)
