"""The mart over tables where one key holds a third of all rows."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stagemart.queries import EXPECTED, QUERIES

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Tables of the mart, written by several tasks; order 0, part 0 and customer 0 are hot."""
    base = tmp_path_factory.mktemp("skewed")
    hot = F.col("id") % 3 == 0
    frames = {
        "region": spark.createDataFrame([(0, "R0"), (1, "R1")], "r_regionkey int, r_name string"),
        "nation": spark.createDataFrame([(n, f"N{n}", n % 2) for n in range(4)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": spark.range(500).selectExpr("id AS c_custkey", "concat('C', id) AS c_name", "int(id % 4) AS c_nationkey"),
        "part": spark.range(800).selectExpr(
            "id AS p_partkey", "concat('P', id) AS p_name", "concat('B', id % 7) AS p_brand", "int(id % 50) AS p_size"
        ),
        "orders": spark.range(0, 20_000, 1, 8).select(
            F.col("id").alias("o_orderkey"),
            F.when(hot, 0).otherwise(F.col("id") % 500).alias("o_custkey"),
            F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(int(id % 900))").alias("o_orderdate"),
        ),
        "lineitem": spark.range(0, 120_000, 1, 8).select(
            F.when(hot, 0).otherwise(F.xxhash64("id") % 10_000 + 10_000).alias("l_orderkey"),
            F.when(hot, 0).otherwise(F.col("id") % 800).alias("l_partkey"),
            (F.col("id") % 9973 / 100).alias("l_extendedprice"),
            (F.col("id") % 11 / 100).alias("l_discount"),
            F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(int(id % 1000))").alias("l_shipdate"),
        ),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{base}/{name}.parquet")
    return str(base)


@pytest.fixture
def small_partitions(spark):
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name in SETTINGS:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", ["dim_one", "dim_two", "fact_one", "mart_sales"])
def test_results_hold_under_skew(spark, skewed, small_partitions, name):
    import duckdb

    duck = duckdb.connect()
    for table in ("region", "nation", "customer", "part", "orders", "lineitem"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{skewed}/{table}.parquet/*.parquet'")
    frame = QUERIES[name](spark, skewed)
    expected = duck.execute(EXPECTED[name])
    names = [column[0] for column in expected.description]
    assert rows_of(frame.select(names)) == sorted(expected.fetchall(), key=repr)


def test_hot_order_is_split(spark, skewed, small_partitions):
    frame = QUERIES["fact_one"](spark, skewed)
    frame.collect()
    assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()


def test_hot_part_is_aggregated_before_the_shuffle(spark, skewed):
    plan = QUERIES["dim_two"](spark, skewed)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(l_partkey") < plan.index("partial_max(l_shipdate")
