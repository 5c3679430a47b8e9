"""Writers. Executors write; nothing is gathered on the driver."""

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line in every part file."""
    df.write.mode(mode).option("header", True).csv(path)


def write_heatmap(heat: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``PULocationID,hour,count``, the layout ``read_heatmap`` takes."""
    write_csv(heat.select("PULocationID", "hour", heat["n"].alias("count")), path, mode)


def write_results(frames: Mapping[str, DataFrame], out_dir: str, mode: str = "overwrite") -> None:
    """One parquet table per result, each under its own name in ``out_dir``."""
    for name, frame in frames.items():
        frame.write.mode(mode).parquet(f"{out_dir.rstrip('/')}/{name}")
