"""Datasets are replaced without a gap."""

import pytest
from conftest import rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stagemart.datasets import _beside, _rename, current_path, current_version, path_exists, replace_dataset
from stagemart.errors import RowCountMismatch
from stagemart.session import hadoop_path
from stagemart.sinks.files import publish_direct, write_files
from stagemart.sources.files import PARQUET, STAGED_CSV, read_files


def _names(spark, folder):
    file_system, found = hadoop_path(spark, folder)
    return sorted(status.getPath().getName() for status in file_system.listStatus(found))


def _failing(spark):
    """Most tasks write their rows before one fails."""
    return spark.range(0, 1000, 1, 8).select(F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("half-way")).cast("long")).alias("id"))


@pytest.mark.parametrize("versioned", [False, True])
@pytest.mark.parametrize("file_format", [PARQUET, STAGED_CSV], ids=["parquet", "csv"])
def test_a_write_that_fails_leaves_the_earlier_rows(spark, folder, file_format, versioned):
    schema = spark.range(1).schema
    write_files(spark.range(7), folder, "t", file_format, versioned=versioned)
    with pytest.raises(PySparkException, match="half-way"):
        write_files(_failing(spark), folder, "t", file_format, versioned=versioned)
    assert rows_of(read_files(spark, folder, "t", file_format, schema)) == [(number,) for number in range(7)]
    write_files(spark.range(3), folder, "t", file_format, versioned=versioned)
    assert rows_of(read_files(spark, folder, "t", file_format, schema)) == [(0,), (1,), (2,)]
    assert _names(spark, folder) == [f"t.{file_format.file_type}"]


def test_a_publish_that_fails_leaves_the_earlier_partitions(spark, folder):
    rows = spark.range(100).withColumn("p", F.col("id") % 4)
    publish_direct(rows, folder, "sales", "t", partition_by=["p"])
    with pytest.raises(PySparkException, match="half-way"):
        publish_direct(_failing(spark).withColumn("p", F.col("id") % 4), folder, "sales", "t", partition_by=["p"])
    assert read_files(spark, f"{folder}/sales", "t").count() == 100


def test_a_dataset_may_be_replaced_by_what_is_read_from_it(spark, folder):
    write_files(spark.range(10), folder, "t")
    write_files(read_files(spark, folder, "t").where("id > 6"), folder, "t")
    assert rows_of(read_files(spark, folder, "t")) == [(7,), (8,), (9,)]


def test_a_writer_that_stopped_between_the_renames(spark, folder):
    path = write_files(spark.range(5), folder, "t")
    _rename(spark, path, _beside(path, "previous"))
    assert current_path(spark, path) == _beside(path, "previous")
    assert read_files(spark, folder, "t").count() == 5
    with pytest.raises(PySparkException, match="half-way"):
        write_files(_failing(spark), folder, "t")
    assert path_exists(spark, path) and spark.read.parquet(path).count() == 5


def test_rows_that_are_not_there_raise(spark, folder):
    write_files(spark.range(5), folder, "t")

    def check(target):
        raise RowCountMismatch(target)

    with pytest.raises(RowCountMismatch):
        replace_dataset(spark, f"{folder}/t.parquet", spark.range(2).write.parquet, check)
    assert read_files(spark, folder, "t").count() == 5


def test_a_version_being_read_outlives_the_next_write(spark, folder):
    write_files(spark.range(5), folder, "t", versioned=True)
    path = f"{folder}/t.parquet"
    first, reader = current_version(spark, path), read_files(spark, folder, "t")
    write_files(spark.range(9), folder, "t", versioned=True)
    assert (reader.count(), read_files(spark, folder, "t").count()) == (5, 9)
    write_files(spark.range(2), folder, "t", versioned=True)
    versions = _names(spark, f"{path}/_versions")
    assert len(versions) == 2 and first not in versions and current_version(spark, path) in versions


def test_no_rows_and_partitions_without_any(spark, folder):
    empty = spark.range(0).withColumn("p", F.col("id"))
    write_files(empty, folder, "t", partition_by=["p"])
    assert read_files(spark, folder, "t", schema=empty.schema).collect() == []
