"""File sinks: stage and mart datasets, and their published copies."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stagemart.datasets import put_text, replace_dataset, same_count
from stagemart.errors import UnsafeOverwrite
from stagemart.names import quoted
from stagemart.operators.decimals import normalize_decimals
from stagemart.session import job_description, qualified, session_setting
from stagemart.sources.files import PARQUET, STATED_SCHEMA, FileFormat, dataset_path, read_files

S3_SCHEMES = ("s3", "s3a", "s3n")


def parse_partition(columns: str | None) -> list[str]:
    """Column names of a ``"a, b"`` setting."""
    return columns.replace(" ", "").split(",") if columns else []


def check_target(target: str | None, by_copy: bool) -> None:
    """An S3 target is ``s3:`` when published by copy and ``s3a:`` when written by the job itself."""
    scheme = (target or "").partition(":")[0]
    wanted = "s3" if by_copy else "s3a"
    if scheme in S3_SCHEMES and scheme != wanted:
        raise ValueError(f"wrong scheme for {target}, please use {wanted}")


def refuse_same_path(spark: SparkSession, source: str, target: str) -> None:
    """An overwrite deletes its target first, so that must not be what it reads."""
    if qualified(spark, source) == qualified(spark, target):
        raise UnsafeOverwrite(f"{target} is both source and target")


def _rebalanced(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return frame.hint("rebalance", *(F.col(quoted(name)) for name in columns))


def _separable(frame: DataFrame, file_format: FileFormat) -> DataFrame:
    """Rows that raise where a value would be cut by the record separator of a CSV file."""
    mark = file_format.record_separator
    if file_format.file_type != "csv" or mark is None:
        return frame
    fault = F.raise_error(F.lit(f"a value holds the record separator {mark!r}"))
    texts = {
        field.name: F.when(F.contains(F.col(quoted(field.name)), F.lit(mark)), fault).otherwise(F.col(quoted(field.name)))
        for field in frame.schema
        if isinstance(field.dataType, StringType)
    }
    return frame.select([texts.get(name, F.col(quoted(name))).alias(name) for name in frame.columns])


def _write(frame: DataFrame, path: str, file_format: FileFormat, partition_by: Sequence[str], versioned: bool = False) -> str:
    """Replace the dataset at ``path``, see ``replace_dataset``; a parquet dataset must hold as many rows as were written."""
    spark, schema, written = frame.sparkSession, frame.schema, Observation()
    rows = _separable(frame, file_format).observe(written, F.count(F.lit(1)).alias("rows"))

    def write(target: str) -> None:
        writer = rows.write.format(file_format.file_type).options(**file_format.write_options)
        with job_description(spark, f"write {path}"):
            (writer.partitionBy(*partition_by) if partition_by else writer).save(target)
        if file_format.file_type == "csv":
            put_text(spark, f"{target}/{STATED_SCHEMA}", schema.json())

    def check(target: str) -> None:
        if file_format.file_type == "parquet":  # the files say how many rows they hold
            same_count(path, written.get["rows"], spark.read.schema(schema).parquet(target).count())

    replace_dataset(spark, path, write, check, versioned)
    return path


def _size_of_parts(frame: DataFrame) -> str:
    """What sizes the partitions of a result: its own ``scan``, its own ``exchange``, or ``nothing`` yet.

    Follows the plan down as long as each step keeps or reduces what it reads.
    """
    for line in frame._jdf.queryExecution().executedPlan().toString().splitlines():
        step = line.strip(" +-*")
        if ":-" in line:
            return "nothing"
        name = re.sub(r"^\(\d+\) ", "", step).split(" ")[0].split("(")[0]
        if name in ("FileScan", "Scan", "BatchScan"):
            return "scan"
        if name == "Exchange":
            return "exchange" if "hashpartitioning" in step and "ENSURE_REQUIREMENTS" in step else "nothing"
        if name not in ("AdaptiveSparkPlan", "Project", "ColumnarToRow", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Sort"):
            return "nothing"
    return "nothing"


def _write_compact(rows: DataFrame, path: str, file_format: FileFormat, versioned: bool) -> str:
    spark, sized = rows.sparkSession, _size_of_parts(rows)
    if sized == "scan":
        wanted = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        with (
            session_setting(spark, "spark.sql.files.maxPartitionBytes", wanted),
            session_setting(spark, "spark.sql.files.minPartitionNum", "1"),
        ):
            return _write(rows, path, file_format, (), versioned)
    # By default, Spark would rather keep all cores busy than reach the advisory size.
    with session_setting(spark, "spark.sql.adaptive.coalescePartitions.parallelismFirst", "false"):
        return _write(rows if sized == "exchange" else _rebalanced(rows, ()), path, file_format, (), versioned)


def write_files(
    frame: DataFrame,
    folder: str,
    table: str,
    file_format: FileFormat = PARQUET,
    partition_by: Sequence[str] = (),
    compact: bool = False,
    versioned: bool = False,
) -> str:
    """Replace ``{folder}/{table}.{file_type}`` by the rows with normalized decimals.

    A write that fails leaves the earlier rows readable, see ``replace_dataset``, which also says what ``versioned`` does.

    A partitioned write is rebalanced by its partition columns first, so that a value does not get
    a file from every task; adaptive execution splits a value that holds much of the data.
    ``compact`` writes files of the advisory partition size, one for a small result, still in
    parallel. A bare scan gets splits of that size, an aggregate's own shuffle is joined to it; only
    other results are shuffled for it.
    """
    rows, path = normalize_decimals(frame), dataset_path(folder, table, file_format)
    if partition_by:
        return _write(_rebalanced(rows, partition_by), path, file_format, partition_by, versioned)
    if compact:
        return _write_compact(rows, path, file_format, versioned)
    return _write(rows, path, file_format, partition_by, versioned)


def publish_direct(
    frame: DataFrame,
    target: str,
    project: str,
    table: str,
    file_format: FileFormat = PARQUET,
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
    versioned: bool = False,
) -> str:
    """Write the rows as they are to ``{target}/{project}/{table}.{file_type}``, on any file system.

    ``rebalance=False`` saves a partitioned write its shuffle where the rows come from files that
    are laid out by the same partitions.
    """
    check_target(target, by_copy=False)
    rows = _rebalanced(frame, partition_by) if partition_by and rebalance else frame
    return _write(rows, dataset_path(f"{target}/{project}", table, file_format), file_format, partition_by, versioned)


def read_staged(
    spark: SparkSession,
    folder: str,
    table: str,
    file_format: FileFormat = PARQUET,
    partition_by: Sequence[str] = (),
    schema: StructType | None = None,
) -> DataFrame:
    """Staged rows for publishing, with CSV columns and partition values as the text they are.

    ``schema`` is that of the staged rows; without one it is read from the files, which an empty
    partitioned or headerless dataset cannot give.
    """
    is_csv = file_format.file_type == "csv"
    as_written = replace(file_format, infer_schema=False)
    schema = schema or read_files(spark, folder, table, as_written).schema
    as_text = schema.names if is_csv else partition_by
    fields = [StructField(f.name, StringType() if f.name in as_text else f.dataType) for f in schema]
    return read_files(spark, folder, table, as_written, StructType(fields))


def publish_copy(
    spark: SparkSession,
    folder: str,
    target: str,
    project: str,
    table: str,
    file_format: FileFormat = PARQUET,
    partition_by: Sequence[str] = (),
    schema: StructType | None = None,
) -> str:
    """Replace the published dataset by a copy of the staged one, see ``read_staged``; raise if that fails."""
    check_target(target, by_copy=True)
    path = dataset_path(f"{target}/{project}", table, file_format)
    refuse_same_path(spark, dataset_path(folder, table, file_format), path)
    staged = read_staged(spark, folder, table, file_format, partition_by, schema)
    # The staged files are laid out by partition already, so no shuffle is needed here.
    return _write(staged, path, file_format, partition_by)
