"""JDBC scans, bounds and sink, over an embedded database; other databases by their options."""

import time
from datetime import date, datetime, timedelta
from decimal import Decimal
from types import SimpleNamespace

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stagemart.errors import RowCountMismatch
from stagemart.queries.database import check_database
from stagemart.sinks import write_table
from stagemart.sources import Database, collect_bounds, key_bounds, read_table


def test_urls_hold_no_password():
    postgres = Database.of_type("postgres", "postgres", 5432, "test", "me", "secret")
    oracle = Database.of_type("Oracle", "oracle", 1521, "test", "me", "secret", "sales")
    assert postgres.options == {"url": "jdbc:postgresql://postgres:5432/test", "user": "me", "password": "secret"}
    assert oracle.options == {"url": "jdbc:oracle:thin:@//oracle:1521/test", "user": "me", "password": "secret"}
    assert oracle.table("orders") == "sales.orders"
    assert "secret" not in repr(postgres)
    with pytest.raises(ValueError):
        Database.of_type("sybase", "h", 1, "d", "u", "p")


def test_database_settings_are_all_or_none():
    names = ("type", "hostname", "port", "username", "password", "database", "schema")
    full = dict(zip(names, ("postgres", "HOST", "5432", "Me", "Secret", "DB", "Mart")))
    database = Database.from_config(full)
    assert (database.url, database.user, database.password, database.schema) == (
        "jdbc:postgresql://host:5432/db", "me", "Secret", "mart",
    )
    assert Database.from_config(dict.fromkeys(names)) is None
    assert Database.from_config({}) is None
    with pytest.raises(ValueError, match="password"):
        Database.from_config(full | {"password": None})


@pytest.mark.parametrize("master", ["local-cluster[3,2,3000]", "spark://host:7077", "yarn"])
def test_no_embedded_database_where_executors_are_other_processes(spark, master):
    def elsewhere(**settings):
        named = {f"spark.stagemart.jdbc.{key}": value for key, value in settings.items()}
        context = SimpleNamespace(master=master, _jvm=spark.sparkContext._jvm)
        return SimpleNamespace(conf=SimpleNamespace(get=named.get), sparkContext=context)

    with pytest.raises(ValueError, match="spark.stagemart.jdbc.url"):
        check_database(elsewhere())
    configured = check_database(elsewhere(url="jdbc:postgresql://host:5432/db", schema="mart"))
    assert (configured.url, configured.schema) == ("jdbc:postgresql://host:5432/db", "mart")


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[4,2]"])
def test_embedded_database_in_local_mode(spark, master):
    context = SimpleNamespace(master=master, _jvm=spark.sparkContext._jvm)
    database = check_database(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context))
    assert database.url.startswith("jdbc:derby:memory:") and database.schema == "APP"


def partition_sizes(frame):
    rows = frame.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return {row["p"]: row["count"] for row in rows}


def test_partitioned_scan(spark, database):
    rows = spark.range(1, 1001).select("id", (F.col("id") * 2).cast("string").alias("v"))
    write_table(rows, database, "numbers")
    bounds = collect_bounds(key_bounds(spark, database, "numbers", "ID"))
    assert bounds == ("1", "1000")
    scanned = read_table(spark, database, "numbers", "id", 4, bounds, fetch_size=100)
    assert rows_of(scanned) == rows_of(rows)
    sizes = partition_sizes(scanned)
    assert len(sizes) == 4 and max(sizes.values()) <= 260


def test_bounds_are_no_filter(spark, database):
    write_table(spark.range(1000).union(spark.sql("SELECT CAST(NULL AS BIGINT)")), database, "numbers")
    scanned = read_table(spark, database, "numbers", "id", 8, (400, 500))
    assert scanned.count() == 1001
    assert scanned.filter("id IS NULL").count() == 1


def test_fewer_keys_than_partitions(spark, database):
    write_table(spark.range(1, 5), database, "few")
    scanned = read_table(spark, database, "few", "id", 8, (1, 4))
    assert scanned.rdd.getNumPartitions() == 3
    assert rows_of(scanned) == [(1,), (2,), (3,), (4,)]
    write_table(spark.range(7, 8), database, "one")
    bounds = collect_bounds(key_bounds(spark, database, "one", "id"))
    assert rows_of(read_table(spark, database, "one", "id", 8, bounds)) == [(7,)]


def test_empty_table(spark, database):
    write_table(spark.range(0), database, "empty")
    bounds = collect_bounds(key_bounds(spark, database, "empty", "id"))
    assert bounds == (None, None)
    scanned = read_table(spark, database, "empty", "id", 8, bounds)
    assert scanned.count() == 0 and scanned.rdd.getNumPartitions() == 1


def test_bounds_of_other_types(spark, database):
    frame = spark.createDataFrame(
        [
            (datetime(2024, 1, 1, 10), date(2024, 1, 1), Decimal("1.5"), -2.5),
            (datetime(2024, 3, 1, 0, 0, 1), date(2024, 3, 1), Decimal("70000000000.25"), 9.25),
        ],
        "ts timestamp_ntz, day date, amount decimal(20,2), ratio double",
    )
    write_table(frame, database, "typed")
    expected = {
        "ts": ("2024-01-01 10:00:00", "2024-03-01 00:00:01"),
        "day": ("2024-01-01", "2024-03-01"),
        "amount": ("1", "70000000001"),
        "ratio": ("-3", "10"),
    }
    for column, bounds in expected.items():
        assert collect_bounds(key_bounds(spark, database, "typed", column)) == bounds
        scanned = read_table(spark, database, "typed", column, 4, bounds)
        assert scanned.rdd.getNumPartitions() == 4
        assert scanned.dtypes[0] == ("ts", "timestamp_ntz")
        assert rows_of(scanned) == rows_of(frame)
    with pytest.raises(ValueError):
        key_bounds(spark, database, "typed", "missing")


def test_timestamp_slices_hold_every_row_once(spark, database):
    times = [(None,)] + [(datetime(2024, 1, 1) + timedelta(minutes=17 * number),) for number in range(900)]
    write_table(spark.createDataFrame(times, "ts timestamp_ntz"), database, "times")
    bounds = collect_bounds(key_bounds(spark, database, "times", "TS"))
    scanned = read_table(spark, database, "times", "TS", 8, bounds)
    sizes = partition_sizes(scanned)
    assert rows_of(scanned) == sorted(times, key=repr)
    assert len(sizes) == 8 and max(sizes.values()) <= 115
    narrow = read_table(spark, database, "times", "ts", 3, ("2024-01-02", "2024-01-03"))
    assert narrow.count() == 901
    assert read_table(spark, database, "times", "ts", 3, ("2024-01-02", "2024-01-02")).count() == 901


def test_filters_and_columns_reach_the_database(spark, database):
    write_table(spark.range(100).withColumn("v", F.col("id") * 3), database, "numbers")
    scanned = read_table(spark, database, "numbers").filter("id < 5").select("v")
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(id,5)" in plan and "ReadSchema: struct<v:bigint>" in plan


def test_overwrite_replaces_rows_and_columns(spark, database):
    write_table(spark.range(50), database, "t")
    name = write_table(spark.sql("SELECT 'a' AS code, 1 AS n"), database, "t", batch_size=1000, num_partitions=2)
    assert name == "APP.t"
    assert rows_of(read_table(spark, database, "t")) == [("a", 1)]


def test_other_row_count_than_sent_is_an_error(spark, database):
    # The frame does not give the same number of rows twice.
    clock = F.udf(lambda _: time.time_ns() // 1000 % 2, "bigint").asNondeterministic()
    drifting = spark.range(20_000).filter(clock("id") == 0)
    with pytest.raises(RowCountMismatch):
        write_table(drifting, database, "t")
    write_table(drifting, database, "t", verify=False)
