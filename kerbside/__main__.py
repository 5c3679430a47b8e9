"""Run a report and publish its results: ``python -m kerbside REPORT --help``."""

import argparse

from pyspark.sql import SparkSession

from kerbside.plans.reports import TRIP_REPORTS, heatmap_report, spatial_report
from kerbside.sources import (
    read_heatmap,
    read_trips,
    read_zone_lookup,
    release_stored,
    write_heatmap,
    write_results,
)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="kerbside", description=__doc__)
    parser.add_argument("report", choices=[*TRIP_REPORTS, "spatial", "heatmap"])
    parser.add_argument("--trips", nargs="+", help="trip parquet: files, folders or globs")
    parser.add_argument(
        "--any-layout", action="store_true", help="take trips with fewer or other columns"
    )
    parser.add_argument("--zones", help="zone lookup CSV (spatial)")
    parser.add_argument(
        "--heatmap", help="heatmap CSV folder (spatial writes it, heatmap reads it)"
    )
    parser.add_argument("--top", type=int, default=15, help="zones in the heatmap by zone")
    parser.add_argument("--out", required=True, help="folder for the result tables")
    options = parser.parse_args(arguments)

    def need(*names: str) -> None:
        for name in names:
            if getattr(options, name) is None:
                parser.error(f"{options.report} needs --{name}")

    def trips():
        need("trips")
        return read_trips(spark, options.trips, strict=not options.any_layout)

    spark = SparkSession.builder.appName(f"kerbside {options.report}").getOrCreate()
    try:
        publish(spark, options, need, trips)
    finally:
        release_stored(spark)


def publish(spark, options, need, trips) -> None:
    """Run the report that the command line names and write its tables."""
    if options.report == "heatmap":
        need("heatmap")
        results = heatmap_report(read_heatmap(spark, options.heatmap), options.top)
    elif options.report == "spatial":
        need("zones", "heatmap")
        results = spatial_report(trips(), read_zone_lookup(spark, options.zones))
        write_heatmap(results.pop("heatmap"), options.heatmap)
    else:
        results = TRIP_REPORTS[options.report](trips())
    write_results(results, options.out)


if __name__ == "__main__":
    main()
