"""Intermediate tables that must outlive an executor."""

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Paths handed out in the shared folder and not yet released.
_kept: list[str] = []


# What this process has written: (application, tables, name) -> path.
_written: dict[tuple[str, str, str], str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a fresh temporary folder. On a
    cluster that would lie on one machine only, so there it is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="kerbside-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses; ``release_stored`` deletes it."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _kept.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as parquet in the shared folder and read back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path as it takes it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def release(spark: SparkSession, path: str) -> None:
    """Delete one table. Frames that read it are void then."""
    files, location = _file_system(spark, path)
    files.delete(location, True)
    if path in _kept:
        _kept.remove(path)
    for key in [key for key, known in _written.items() if known == path]:
        del _written[key]


def release_stored(spark: SparkSession) -> None:
    """Delete every table under a path that ``fresh_path`` or ``stored`` has handed out."""
    while _kept:
        release(spark, _kept[-1])


def written_once(
    spark: SparkSession, tables: str, name: str, write: Callable[[str], None]
) -> str:
    """The path of a table derived from the tables in a folder, written once per application.

    Nothing is listed or compared on later calls; ``refresh`` makes the next one write anew.
    """
    key = (spark.sparkContext.applicationId, tables, name)
    if key not in _written:
        path = fresh_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def refresh(spark: SparkSession, tables: str) -> None:
    """Delete what was derived from the tables in a folder. To be called when they have changed."""
    application = spark.sparkContext.applicationId
    for path in [path for key, path in _written.items() if key[:2] == (application, tables)]:
        release(spark, path)


def session_for_shuffle(spark: SparkSession, partitions: int | None) -> SparkSession:
    """A session of its own with a number of shuffle partitions, for one wide job.

    The caller's session keeps its number, also for queries that run at the same time.
    Without a number it is the caller's session.
    """
    if partitions is None:
        return spark
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session
