"""Order-free digests of datasets, kept beside them, and publishing that copies and checks by them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from stagemart.datasets import current_path, path_exists, replace_dataset
from stagemart.errors import DigestMismatch
from stagemart.names import as_spelled, quoted
from stagemart.operators.decimals import normalize_decimals
from stagemart.session import delete_path, hadoop_path, job_description
from stagemart.sinks.files import check_target, read_staged, refuse_same_path, write_files
from stagemart.sources.files import PARQUET, FileFormat, dataset_path, read_files

#: The folder of a dataset's digests, which readers pass over.
MANIFEST = "_digest"
_ROWS, _DIGEST = "__rows", "__digest"


def row_hash(schema: StructType, partition_by: Sequence[str] = ()) -> Column:
    """A hash of all values of a row, whatever the order of its columns; of partition columns the text, of a map the entries by key."""
    values = []
    for field in sorted(schema, key=lambda field: field.name):
        value = F.col(quoted(field.name))
        if field.name in partition_by:
            value = value.cast("string")
        values.append(F.array_sort(F.map_entries(value)) if isinstance(field.dataType, MapType) else value)
    return F.xxhash64(*values)


def dataset_digest(frame: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """A row for each partition: its columns, ``__rows`` and ``__digest``, the count of rows and the sum of their hashes.

    Neither depends on the order of the rows or on files. A changed, lost or doubled row changes them. Without
    partitions it is one row, also for no rows. Rows are added up before the shuffle.
    """
    columns = [F.col(quoted(name)) for name in partition_by]
    total = F.coalesce(F.sum(row_hash(frame.schema, partition_by).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return frame.groupBy(*columns).agg(F.count(F.lit(1)).alias(_ROWS), total.alias(_DIGEST))


def _folder_names(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """With partition values as text, as the names of folders have them."""
    return rows.select(*(F.col(quoted(name)).cast("string").alias(name) for name in partition_by), _ROWS, _DIGEST)


def differing(wanted: DataFrame, held: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The partitions whose digests differ, with ``__rows`` and ``__digest`` as wanted; null where the partition should not be there."""
    def same(name: str) -> Column:
        return F.col(f"w.{quoted(name)}").eqNullSafe(F.col(f"h.{quoted(name)}"))

    on = F.lit(True)
    for name in partition_by:
        on = on & same(name)
    both = wanted.alias("w").join(held.alias("h"), on, "full_outer") if partition_by else wanted.alias("w").join(held.alias("h"), F.lit(True), "left")
    columns = [F.when(F.col(f"w.{_ROWS}").isNotNull(), F.col(f"w.{quoted(name)}")).otherwise(F.col(f"h.{quoted(name)}")).alias(name) for name in partition_by]
    return both.where(~same(_ROWS) | ~same(_DIGEST)).select(*columns, F.col(f"w.{_ROWS}"), F.col(f"w.{_DIGEST}"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The digests stored with a dataset; None if there are none."""
    found = current_path(spark, f"{path}/{MANIFEST}")
    return spark.read.parquet(found) if path_exists(spark, found) else None


def write_manifest(path: str, digests: DataFrame) -> None:
    replace_dataset(digests.sparkSession, f"{path}/{MANIFEST}", digests.coalesce(1).write.parquet, lambda _: None)


def write_digested(
    frame: DataFrame, folder: str, table: str, partition_by: Sequence[str] = (), file_format: FileFormat = PARQUET, **options: bool
) -> str:
    """``write_files``, with digests of what the files hold stored beside them, which must add up to those of the rows as they were written.

    The sum over all rows is taken while they are written, and the files are read once for those of each partition. Raises
    ``DigestMismatch`` if they differ. Parquet only, as CSV files do not keep types.
    """
    if file_format.file_type != "parquet":
        raise ValueError("only parquet files keep the types that digests depend on")
    rows, seen = normalize_decimals(frame), Observation()
    partition_by = list(as_spelled(rows.schema, partition_by))
    total = F.sum(row_hash(rows.schema, partition_by).cast("decimal(38,0)"))
    path = write_files(rows.observe(seen, F.count(F.lit(1)).alias("rows"), total.alias("digest")), folder, table, file_format, partition_by, **options)
    held = read_files(frame.sparkSession, folder, table, file_format, rows.schema).select([quoted(name) for name in rows.columns])
    found = _held(frame.sparkSession, _folder_names(dataset_digest(held, partition_by), partition_by))
    sums = found.agg(F.coalesce(F.sum(_ROWS), F.lit(0)).alias("rows"), F.sum(_DIGEST).alias("digest")).first()
    if (sums["rows"], sums["digest"] or 0) != (seen.get["rows"], seen.get["digest"] or 0):
        raise DigestMismatch(f"{path} does not hold the rows that were written")
    write_manifest(path, found)
    return path


def check_dataset(
    spark: SparkSession, folder: str, table: str, file_format: FileFormat = PARQUET, partition_by: Sequence[str] = (), schema: StructType | None = None
) -> int:
    """Read a published dataset whole and compare it with its stored digests; the number of its partitions. Raises ``DigestMismatch``."""
    path = dataset_path(folder, table, file_format)
    stored = read_manifest(spark, path)
    if stored is None:
        raise DigestMismatch(f"{path} has no digests")
    found = _folder_names(dataset_digest(read_staged(spark, folder, table, file_format, partition_by, schema), partition_by), partition_by)
    _raise_on(differing(stored, found, partition_by), path)
    return stored.count()


def _raise_on(wrong: DataFrame, path: str) -> None:
    some = wrong.limit(5).collect()
    if some:
        names = "; ".join(", ".join(f"{name}={row[name]}" for name in wrong.columns[:-2]) or "the whole dataset" for row in some)
        raise DigestMismatch(f"{path} does not hold the rows it should, among others in {names}")


@dataclass(frozen=True)
class Published:
    """Where the dataset is, and how many of its partitions were copied, kept as they were, and removed."""

    path: str
    copied: int
    kept: int
    removed: int


def publish_changed(
    spark: SparkSession,
    folder: str,
    target: str,
    project: str,
    table: str,
    file_format: FileFormat = PARQUET,
    partition_by: Sequence[str] = (),
    schema: StructType | None = None,
) -> Published:
    """Make the published dataset equal the staged one by copying the partitions whose digests differ, and check what was copied.

    The staged rows are read once for their digests, and those of changed partitions once more to copy them;
    the copies are read back, and ``DigestMismatch`` is raised unless they hold the same rows. What was published is known
    by its stored digests; partitions that are not staged any more are removed. A dataset without
    digests is copied whole. The stored digests are dropped before anything is changed, so that a run that
    fails is followed by a whole copy. ``check_dataset`` reads a published dataset whole. Partitions are replaced one by
    one; a dataset without partitions is replaced without a gap.
    """
    check_target(target, by_copy=True)
    path, partition_by = dataset_path(f"{target}/{project}", table, file_format), list(partition_by)
    refuse_same_path(spark, dataset_path(folder, table, file_format), path)
    staged = read_staged(spark, folder, table, file_format, partition_by, schema)
    wanted = _held(spark, _folder_names(dataset_digest(staged, partition_by), partition_by))
    stored = read_manifest(spark, path)
    held = _held(spark, stored) if stored is not None else _held(spark, wanted.limit(0))
    changed = differing(wanted, held, partition_by)
    changes = changed.select(F.count(_ROWS).alias("copied"), F.count_if(F.col(_ROWS).isNull()).alias("removed")).first()
    whole = stored is None or not partition_by
    if changes["copied"] or changes["removed"] or stored is None:
        gone = changed.where(F.col(_ROWS).isNull()).drop(_ROWS, _DIGEST).collect()
        delete_path(spark, f"{path}/{MANIFEST}")
        rows = staged if whole else _of_partitions(staged, changed.where(F.col(_ROWS).isNotNull()), partition_by)
        if whole:
            replace_dataset(spark, path, lambda at: _save(rows, at, file_format, partition_by, {}), lambda _: None)
        elif changes["copied"]:
            _save(rows, path, file_format, partition_by, {"partitionOverwriteMode": "dynamic"})
        for partition in gone:
            _remove_partition(spark, path, partition.asDict())
        copied = read_staged(spark, f"{target}/{project}", table, file_format, partition_by, staged.schema)
        if not whole:
            copied = _of_partitions(copied, changed, partition_by)
        found = _folder_names(dataset_digest(copied, partition_by), partition_by)
        expected = wanted if whole else changed.where(F.col(_ROWS).isNotNull())
        _raise_on(differing(expected, found, partition_by), path)
        write_manifest(path, wanted)
    total = wanted.count()
    copied_count = total if whole and (stored is None or changes["copied"]) else changes["copied"]
    return Published(path, copied_count, total - copied_count, changes["removed"])


def _held(spark: SparkSession, digests: DataFrame) -> DataFrame:
    """A row a partition, as small as a listing of the dataset's folders: held by the driver, so that it is not computed anew."""
    return spark.createDataFrame(digests.toArrow()) if digests.columns else digests


def _of_partitions(rows: DataFrame, partitions: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The rows of those partitions; other partitions are not read."""
    wanted = partitions.select(*(F.col(quoted(name)).alias(f"__p{number}") for number, name in enumerate(partition_by)))
    on = F.lit(True)
    for number, name in enumerate(partition_by):
        on = on & F.col(quoted(name)).cast("string").eqNullSafe(F.col(f"__p{number}"))
    return rows.join(F.broadcast(wanted), on, "left_semi")  # as small as a listing of folders


def _save(rows: DataFrame, path: str, file_format: FileFormat, partition_by: Sequence[str], options: dict[str, str]) -> None:
    writer = rows.write.format(file_format.file_type).mode("overwrite" if options else "errorifexists").options(**file_format.write_options | options)
    with job_description(rows.sparkSession, f"write {path}"):
        (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def _remove_partition(spark: SparkSession, path: str, values: dict[str, str | None]) -> None:
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folder = "/".join(utils.getPartitionPathString(name, value) for name, value in values.items())
    file_system, found = hadoop_path(spark, f"{path}/{folder}")
    file_system.delete(found, True)
