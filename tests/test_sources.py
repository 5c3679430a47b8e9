from datetime import datetime
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F
from trips import PICKUP, frame, trip

from kerbside.operators import heatmap
from kerbside.plans import catalog
from kerbside.sources import (
    TRIP_COLUMNS,
    mapped,
    read_heatmap,
    read_trips,
    read_zone_lookup,
    refresh,
    release_stored,
    session_for_shuffle,
    shared_folder,
    stored,
    trips_table,
    write_heatmap,
    write_results,
)


def test_read_trips_from_several_files(spark, tmp_path):
    for name in ("jan", "feb"):
        frame(spark, [trip()]).write.parquet(f"{tmp_path}/{name}")
    both = read_trips(spark, [f"{tmp_path}/jan", f"{tmp_path}/feb"])
    assert both.columns == TRIP_COLUMNS
    assert both.count() == read_trips(spark, f"{tmp_path}/*").count() == 2


def test_read_trips_orders_columns_and_refuses_unknown_ones(spark, tmp_path):
    odd = frame(spark, [trip()]).select(*reversed(TRIP_COLUMNS), F.lit(1).alias("note"))
    odd = odd.withColumnRenamed("Airport_fee", "airport_fee")
    odd.drop("note").write.parquet(f"{tmp_path}/t")
    assert read_trips(spark, f"{tmp_path}/t").columns == TRIP_COLUMNS
    odd.write.parquet(f"{tmp_path}/u")
    with pytest.raises(ValueError, match="note"):
        read_trips(spark, f"{tmp_path}/u")
    assert "note" in read_trips(spark, f"{tmp_path}/u", strict=False).columns


def test_months_with_other_types_and_columns(spark, tmp_path):
    month = frame(spark, [trip(passenger_count=2)])
    month.write.parquet(f"{tmp_path}/a")
    other = month.withColumn("passenger_count", F.col("passenger_count").cast("double"))
    other = other.withColumn("VendorID", F.col("VendorID").cast("bigint"))
    other.write.parquet(f"{tmp_path}/b")
    both = read_trips(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert both.dtypes == month.dtypes
    assert both.filter("passenger_count = 2 AND VendorID = 1").count() == 2
    other.drop("cbd_congestion_fee").write.parquet(f"{tmp_path}/c")
    three = read_trips(spark, [f"{tmp_path}/{name}" for name in "abc"], strict=False)
    assert three.filter("cbd_congestion_fee IS NULL").count() == 1 and three.count() == 3


def test_read_trips_names_missing_columns(spark, tmp_path):
    frame(spark, [trip()]).drop("fare_amount", "extra").write.parquet(f"{tmp_path}/t")
    with pytest.raises(ValueError, match="fare_amount, extra"):
        read_trips(spark, f"{tmp_path}/t")


def test_other_layouts_keep_what_they_have(spark, tmp_path):
    older = frame(spark, [trip()]).drop("cbd_congestion_fee").withColumn("ehail_fee", F.lit(1))
    older.write.parquet(f"{tmp_path}/t")
    with pytest.raises(ValueError, match="cbd_congestion_fee"):
        read_trips(spark, f"{tmp_path}/t")
    assert read_trips(spark, f"{tmp_path}/t", strict=False).columns == older.columns
    older.drop("tip_amount").write.parquet(f"{tmp_path}/u")
    with pytest.raises(ValueError, match="tip_amount"):
        read_trips(spark, f"{tmp_path}/u", strict=False)


def test_times_with_a_zone_become_wall_clock(spark, tmp_path):
    zoned = frame(spark, [trip()]).withColumn(
        "tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp")
    )
    zoned.write.parquet(f"{tmp_path}/t")
    trips = read_trips(spark, f"{tmp_path}/t")
    assert dict(trips.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
    assert trips.first()["tpep_pickup_datetime"] == PICKUP


def test_zone_lookup(spark, tmp_path):
    file = tmp_path / "zones.csv"
    file.write_text(
        '"LocationID","Borough","Zone","service_zone"\n'
        '1,"North","Old, Town",x\nnone,"South","Port",y\n,"East","Hill",z\n'
    )
    zones = read_zone_lookup(spark, str(file))
    assert zones.dtypes == [("LocationID", "int"), ("Borough", "string"), ("Zone", "string")]
    assert [tuple(r) for r in zones.collect()] == [
        (1, "North", "Old, Town"),
        (None, "South", "Port"),
        (None, "East", "Hill"),
    ]


def test_heatmap_csv_layout(spark, tmp_path):
    heat = heatmap(frame(spark, [trip(), trip(), trip(PULocationID=5)]))
    write_heatmap(heat, f"{tmp_path}/h")
    lines = [p.read_text().splitlines() for p in (tmp_path / "h").glob("*.csv")]
    assert all(part[0] == "PULocationID,hour,count" for part in lines)
    assert sorted(line for part in lines for line in part[1:]) == ["1,8,2", "5,8,1"]
    back = read_heatmap(spark, f"{tmp_path}/h")
    assert back.dtypes == [("PULocationID", "int"), ("hour", "int"), ("n", "bigint")]
    assert sorted(map(tuple, back.collect())) == [(1, 8, 2), (5, 8, 1)]


def test_write_results_overwrites(spark, tmp_path):
    for count in (3, 2):
        write_results({"numbers": spark.range(count)}, f"{tmp_path}/out/")
    assert spark.read.parquet(f"{tmp_path}/out/numbers").count() == 2


def test_shared_folder_follows_the_setting(spark):
    assert spark.conf.get("spark.checkpoint.dir") in shared_folder(spark)


def test_stored_keeps_rows_and_types(spark):
    df = frame(spark, [trip(), trip(passenger_count=None)])
    kept = stored(df, "kept")
    assert kept.dtypes == df.dtypes
    assert sorted(map(str, kept.collect())) == sorted(map(str, df.collect()))
    assert stored(df, "kept").inputFiles() != kept.inputFiles()


def test_stored_tables_can_be_released(spark):
    kept = stored(spark.range(3), "kept")
    folder = Path(urlparse(kept.inputFiles()[0]).path).parent
    assert folder.exists()
    release_stored(spark)
    assert not folder.exists()


def test_a_session_for_a_wide_shuffle_leaves_the_callers_alone(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    assert session_for_shuffle(spark, 400_000).conf.get(key) == "400000"
    assert spark.conf.get(key) == before
    assert session_for_shuffle(spark, None) is spark


def _order_tables(spark, folder, lines):
    spark.createDataFrame(
        [(1, 10, 20, 1 + i % 7, 4.0, 1000.0, 0.05, "F") for i in range(lines)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_linestatus string",
    ).write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(
        [(1, "2-HIGH")], "o_orderkey long, o_orderpriority string"
    ).write.mode("overwrite").parquet(f"{folder}/orders.parquet")


def test_trips_are_written_once_and_anew_after_a_refresh(spark, tmp_path):
    _order_tables(spark, str(tmp_path), 3)
    first = trips_table(spark, str(tmp_path))
    assert trips_table(spark, str(tmp_path)).inputFiles() == first.inputFiles()
    assert first.count() == 3
    folder = Path(urlparse(first.inputFiles()[0]).path).parent
    _order_tables(spark, str(tmp_path), 50)
    refresh(spark, str(tmp_path))
    assert not folder.exists()
    assert trips_table(spark, str(tmp_path), partitions=3).count() == 50
    assert len(trips_table(spark, str(tmp_path)).inputFiles()) == 3
    release_stored(spark)
    assert trips_table(spark, str(tmp_path)).count() == 50


def test_a_second_query_starts_no_job_to_be_built(spark):
    catalog.QUERIES["clean_model"](spark, "/root/testdata/sf0.001")
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    catalog.QUERIES["clean_model"](spark, "/root/testdata/sf0.001")
    assert len(jobs.getJobIdsForGroup(None)) == before


def test_nothing_is_left_after_all_queries_and_a_release(spark):
    for query in catalog.QUERIES.values():
        query(spark, "/root/testdata/sf0.001")
    release_stored(spark)
    folder = Path(urlparse(shared_folder(spark)).path)
    assert [path.name for path in folder.iterdir()] == []


def test_mapped_trips_types_match_the_declared_ones(spark):
    trips = mapped.mapped_trips(spark, "/root/testdata/sf0.001")
    declared = frame(spark, []).dtypes
    assert trips.dtypes == declared
    assert trips.agg(F.min("tpep_pickup_datetime")).first()[0] < datetime(2008, 1, 1)
