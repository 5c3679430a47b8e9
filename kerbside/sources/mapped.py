"""Trips and zones derived from order tables (``lineitem``, ``orders``, ``nation``, ``region``).

One trip per order line. Distances and amounts are multiples of 0.25, so sums of
doubles are exact in any order of addition.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.sources.readers import conform_trips, read_trips, read_zone_lookup
from kerbside.sources.schema import TRIP_COLUMNS, TRIP_SCHEMA
from kerbside.sources.shared import session_for_shuffle, written_once
from kerbside.sources.sinks import write_csv

_AMOUNTS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "Airport_fee",
    "cbd_congestion_fee",
)


def _first_match(cases: list[tuple[int, Column]], otherwise: Column) -> Column:
    """The value of the first divisor that divides ``h``."""
    value = None
    for divisor, result in cases:
        hit = F.col("h") % divisor == 0
        value = F.when(hit, result) if value is None else value.when(hit, result)
    return value.otherwise(otherwise)


def _unless_card(value: Column) -> Column:
    return F.when(F.col("h") % 11 != 0, value)


def mapped_trips(spark: SparkSession, tables: str) -> DataFrame:
    """Trips from the tables in folder ``tables``.

    The join carries no hint. Catalyst broadcasts ``orders`` while its size is under
    the session's threshold; beyond that it is a sort-merge join directly on two
    shuffles, the shape whose hot keys adaptive execution splits.
    """
    orders = spark.read.parquet(f"{tables}/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"),
        (F.substring("o_orderpriority", 1, 1).cast("bigint") - 1).alias("payment_type"),
    )
    lines = spark.read.parquet(f"{tables}/lineitem.parquet").join(orders, "l_orderkey", "left")
    lines = lines.withColumn(
        "h",
        F.col("l_orderkey") * 7
        + F.col("l_partkey") * 13
        + F.col("l_suppkey") * 17
        + F.col("l_linenumber") * 19
        + F.col("l_quantity").cast("bigint") * 23,
    )

    h = F.col("h")
    base = F.when(h % 1009 == 0, F.expr("TIMESTAMP_NTZ'2007-12-05 00:00:00'")).otherwise(
        F.expr("TIMESTAMP_NTZ'2025-03-01 00:00:00'")
    )
    seconds = _first_match(
        [
            (97, F.lit(0)),
            (101, F.lit(-60)),
            (211, F.lit(20000)),
            (223, F.lit(12000)),
            (227, F.lit(30)),
        ],
        60 + h * 31 % 5400,
    )
    fare = F.when(h % 503 == 0, F.lit(250.0)).otherwise(
        3.0 + F.col("l_quantity") * 0.5 + F.floor(F.col("l_extendedprice") / 10000) * 0.5
    )
    pickup_zone = F.least(h % 27, h % 31).cast("int")

    columns = {
        "VendorID": (1 + F.col("l_linenumber") % 2).cast("int"),
        "tpep_pickup_datetime": F.timestamp_add("SECOND", (h * 7919 % 2678400).cast("int"), base),
        "passenger_count": _unless_card((F.col("l_linenumber") % 7).cast("bigint")),
        "trip_distance": _first_match(
            [(89, F.lit(0.0)), (401, F.col("l_quantity") * 2)], F.col("l_quantity") * 0.25
        ),
        "RatecodeID": _unless_card(1 + h % 6),
        "store_and_fwd_flag": _unless_card(
            F.when(F.col("l_linestatus") == "F", "N").otherwise("Y")
        ),
        "PULocationID": pickup_zone,
        "DOLocationID": (F.col("l_partkey") % 27).cast("int"),
        "fare_amount": _first_match([(53, F.lit(-1.0)), (59, F.lit(0.0))], F.lit(1.0)) * fare,
        "tip_amount": F.when(
            F.col("payment_type") == 1, F.round(F.col("l_discount") * 100) * 0.25
        ).otherwise(0.0),
        "extra": F.lit(1.0),
        "mta_tax": F.lit(0.5),
        "tolls_amount": _first_match([(17, F.lit(6.5))], F.lit(0.0)),
        "improvement_surcharge": F.lit(1.0),
        "congestion_surcharge": _unless_card(F.lit(2.5)),
        "Airport_fee": _unless_card(F.when(pickup_zone == 3, 1.75).otherwise(0.0)),
        "cbd_congestion_fee": F.lit(0.75),
    }
    trips = lines.withColumns(columns).withColumn(
        "tpep_dropoff_datetime",
        F.timestamp_add("SECOND", seconds.cast("int"), F.col("tpep_pickup_datetime")),
    )
    total = sum((F.coalesce(F.col(name), F.lit(0.0)) for name in _AMOUNTS), F.lit(0.0))
    return conform_trips(trips.withColumn("total_amount", total).select(*TRIP_COLUMNS))


def mapped_zones(spark: SparkSession, tables: str) -> DataFrame:
    """The zone lookup: nations as zones, regions as boroughs."""
    nation = spark.read.parquet(f"{tables}/nation.parquet")
    region = spark.read.parquet(f"{tables}/region.parquet")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        nation["n_nationkey"].alias("LocationID"),
        region["r_name"].alias("Borough"),
        nation["n_name"].alias("Zone"),
    )


def trips_table(
    spark: SparkSession,
    tables: str,
    partitions: int | None = None,
    shuffle_partitions: int | None = None,
) -> DataFrame:
    """The mapped trips as a stored trip table.

    Deriving a trip takes a join and some hundred operations, and no filter on a derived
    column can reach the scan. So the table is written once per application, and each
    query reads the columns and row groups it needs. Its files are as the input's, or
    ``partitions`` of them where the first caller says so. ``shuffle_partitions`` is the
    number for the join of whole tables: a few hundred megabytes each is a good size.
    """

    def write(path: str) -> None:
        trips = mapped_trips(session_for_shuffle(spark, shuffle_partitions), tables)
        (trips if partitions is None else trips.repartition(partitions)).write.parquet(path)

    return read_trips(spark, written_once(spark, tables, "trips", write), TRIP_SCHEMA)


def zones_table(spark: SparkSession, tables: str) -> DataFrame:
    """The mapped zone lookup as a stored CSV."""

    def write(path: str) -> None:
        write_csv(mapped_zones(spark, tables), path)

    return read_zone_lookup(spark, written_once(spark, tables, "zone-lookup", write))
