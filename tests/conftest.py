import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("kerbside-tests")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # A zone with daylight saving: results must not depend on the session's zone.
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kerbside-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
