"""External tables over published parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stagemart.names import quoted

_PARTITIONS_A_STATEMENT = 500


def create_external_table(
    spark: SparkSession, name: str, schema: StructType, location: str, partition_by: Sequence[str] = (), written: DataFrame | None = None
) -> None:
    """Declare ``name`` (``database.table``) over the parquet files at ``location``.

    Replaces an earlier declaration and never touches the files. With ``written``, a row for each partition with its
    columns as text and ``__rows``, as ``write_digested`` stores them (see ``read_manifest``), these
    partitions are added to the catalog, and the number of rows is noted as the property ``stagemart.rows``; the files are not listed.
    Without it, partitions found below the location are added.
    """
    database, _, _ = name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_identifier(database)}")
    drop_external_table(spark, name)
    columns = ", ".join(f"{quoted(field.name)} {field.dataType.simpleString()}" for field in schema)
    partitions = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    path = _text(location)
    spark.sql(f"CREATE TABLE {_identifier(name)} ({columns}) USING parquet {partitions} LOCATION {path}")
    if written is not None:
        _add_written(spark, name, location, list(partition_by), written)
    elif partition_by:
        spark.sql(f"MSCK REPAIR TABLE {_identifier(name)}")


def _add_written(spark: SparkSession, name: str, location: str, partition_by: list[str], written: DataFrame) -> None:
    """Add partitions in statements of bounded length, each with its folder, and note the number of rows as a property."""
    told = written.select(*(F.col(quoted(column)) for column in partition_by), "__rows").collect()  # a row a folder
    folder_of = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for start in range(0, len(told) if partition_by else 0, _PARTITIONS_A_STATEMENT):
        added = []
        for row in told[start : start + _PARTITIONS_A_STATEMENT]:
            values = ", ".join(f"{quoted(column)} = {'NULL' if row[column] is None else _text(row[column])}" for column in partition_by)
            folder = "/".join(folder_of(column, row[column]) for column in partition_by)
            added.append(f"PARTITION ({values}) LOCATION {_text(f'{location}/{folder}')}")
        spark.sql(f"ALTER TABLE {_identifier(name)} ADD IF NOT EXISTS {' '.join(added)}")
    rows = sum(row["__rows"] for row in told)
    spark.sql(f"ALTER TABLE {_identifier(name)} SET TBLPROPERTIES ('stagemart.rows' = '{rows}')")


def drop_external_table(spark: SparkSession, name: str) -> None:
    """Remove the declaration; the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_identifier(name)}")


def _identifier(name: str) -> str:
    return ".".join(map(quoted, name.split(".")))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
