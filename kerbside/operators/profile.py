"""Profile of raw trips: size, period, nulls, outliers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.rules import outlier_flags

_SUMMARY = ("n", "period_start", "period_end")


def profile_row(trips: DataFrame) -> DataFrame:
    """Every profile figure in one wide row, from one pass.

    Selecting some of its columns prunes the other aggregates, and the scan with them.
    """
    return trips.agg(
        F.count("*").alias("n"),
        F.min("tpep_pickup_datetime").alias("period_start"),
        F.max("tpep_pickup_datetime").alias("period_end"),
        *[F.count_if(flag).alias(name) for name, flag in outlier_flags().items()],
        *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in trips.columns],
    )


def profile_summary(row: DataFrame) -> DataFrame:
    """Trip count, first and last pickup."""
    return row.select(*_SUMMARY)


def outlier_counts(row: DataFrame) -> DataFrame:
    """The four outlier counts."""
    return row.select(*outlier_flags())


def null_profile(row: DataFrame) -> DataFrame:
    """``column_name`` and ``null_count``, one row per trip column."""
    pairs = [
        F.struct(
            F.lit(name.removeprefix("null_")).alias("column_name"),
            F.col(name).alias("null_count"),
        )
        for name in row.columns
        if name.startswith("null_")
    ]
    return row.select(F.inline(F.array(*pairs)))
