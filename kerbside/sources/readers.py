"""Readers: trips (parquet), zone lookup (CSV), heatmap (CSV)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.sources.schema import HEATMAP_SCHEMA, TRIP_COLUMNS, TRIP_SCHEMA, USED_COLUMNS


def conform_trips(df: DataFrame, strict: bool = True) -> DataFrame:
    """``df`` as a trip table; a missing column is an error.

    ``strict`` asks for the 20 known columns, gives them in order and refuses others. Without
    it the columns that operators use must be there, and all that are there are kept.

    Types come from the file. Only times stored with a zone are brought to wall
    clock; every other column stays a bare reference, so filters on it still reach
    the parquet scan.
    """
    wanted = TRIP_COLUMNS if strict else USED_COLUMNS
    types = {field.name.lower(): field.dataType for field in df.schema}
    missing = [name for name in wanted if name.lower() not in types]
    if missing:
        raise ValueError(f"not a trip table, columns missing: {', '.join(missing)}")
    if strict:
        known = {name.lower() for name in TRIP_COLUMNS}
        unknown = [name for name in df.columns if name.lower() not in known]
        if unknown:
            raise ValueError(f"unknown columns in a trip table: {', '.join(unknown)}")
    zoned = [n for n in wanted if isinstance(types[n.lower()], T.TimestampType)]
    for name in zoned:
        df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
    if not strict or df.columns == TRIP_COLUMNS:
        return df
    return df.select(*[F.col(name).alias(name) for name in TRIP_COLUMNS])


def read_trips(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    strict: bool = True,
) -> DataFrame:
    """One file, a folder, a glob or a list of them.

    Paths of a list may differ in the types of their columns, as months do: each layout is read
    with its own types and brought to the trip schema. Files under one path have one layout.
    A ``schema`` known beforehand saves the job that reads it from the files.
    ``strict=False`` takes other layouts, such as files from before a fee came in.
    """
    paths = [path] if isinstance(path, str) else path
    if schema is not None:
        return conform_trips(spark.read.schema(schema).parquet(*paths), strict)
    # Paths of one layout are read together, each layout with its own types.
    layouts: dict[str, list[str]] = {}
    for each in paths:
        layouts.setdefault(spark.read.parquet(each).schema.json(), []).append(each)
    parts = [conform_trips(spark.read.parquet(*same), strict) for same in layouts.values()]
    if len(parts) == 1:
        return parts[0]
    parts = [_with_trip_types(part) for part in parts]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=not strict)
    return every


def _with_trip_types(df: DataFrame) -> DataFrame:
    """Known columns under their names and types. Only those that differ are cast, so a filter
    on the others still reaches the scan."""
    own = {field.name.lower(): field for field in df.schema}
    for field in TRIP_SCHEMA:
        found = own.get(field.name.lower())
        if found is None:
            continue
        if found.dataType != field.dataType:
            df = df.withColumn(found.name, F.col(found.name).cast(field.dataType))
        if found.name != field.name:
            df = df.withColumnRenamed(found.name, field.name)
    return df


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """LocationID, Borough, Zone. An id that is not a number becomes null."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(F.col("LocationID").try_cast("int").alias("LocationID"), "Borough", "Zone")


def read_heatmap(spark: SparkSession, path: str) -> DataFrame:
    """The heatmap CSV as the heatmap operators take it: its ``count`` becomes ``n``."""
    csv = spark.read.schema(HEATMAP_SCHEMA).option("header", True).csv(path)
    return csv.withColumnRenamed("count", "n")
