import pytest
from pyspark.sql import SparkSession

from tierstream.session import pipeline_session


@pytest.fixture(scope="session")
def raw_spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tierstream-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def spark(raw_spark):
    return pipeline_session(raw_spark)
