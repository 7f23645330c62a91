import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALLEST = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("stagemart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file:{folder}/shared")
        .config("spark.sql.warehouse.dir", f"file:{folder}/warehouse")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A new folder, as a URI."""
    from stagemart.session import new_folder

    return new_folder(spark, "test")


@pytest.fixture
def database(spark):
    """A new embedded database inside the test process."""
    from stagemart.queries.database import check_database

    return check_database(spark)


@pytest.fixture(scope="session")
def duck():
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALLEST}/{name}.parquet'")
    return connection


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)
