import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("careflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Small frame from (columns, rows); every column is text unless a schema is given."""

    def make(columns, rows):
        schema = columns if isinstance(columns, str) else ", ".join(
            f"`{c}` string" for c in columns
        )
        return spark.createDataFrame(rows, schema)

    return make
