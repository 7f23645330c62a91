"""Datasets that are replaced as a whole: written beside, checked, and switched to."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from stagemart.errors import RowCountMismatch
from stagemart.session import delete_path, hadoop_path

#: File systems whose renames copy, so that a half-done one could be seen.
OBJECT_STORES = ("s3", "s3a", "s3n", "gs", "oss", "cos")
POINTER, VERSIONS = "_current", "_versions"


def _beside(path: str, label: str) -> str:
    """A hidden sibling, which readers of the folder above pass over."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{name}.{label}"


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, found = hadoop_path(spark, path)
    return file_system.exists(found)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    file_system, found = hadoop_path(spark, source)
    if not file_system.rename(found, hadoop_path(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, by one rename over an earlier one where the file system has that."""
    folder, _, name = path.rpartition("/")
    file_system, found = hadoop_path(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    out = file_system.create(found, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = gateway.new_array(kinds, 1)
    over[0] = kinds.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(found.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(found, hadoop_path(spark, path)[1], over)


def get_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None if there is none."""
    file_system, found = hadoop_path(spark, path)
    if not file_system.exists(found):
        return None
    source = file_system.open(found)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, length and time of change of each file of a dataset, in order; none if it is not there."""
    file_system, root = hadoop_path(spark, path)
    if not file_system.exists(root):
        return []
    listed, found = file_system.listFiles(root, True), []
    while listed.hasNext():
        status = listed.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version that the pointer of a versioned dataset names; None without a pointer."""
    return get_text(spark, f"{path}/{POINTER}")


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of a dataset are now: the version its pointer names, or what a writer that stopped between two renames left."""
    version = current_version(spark, path)
    if version is not None:
        return f"{path}/{VERSIONS}/{version}"
    previous = _beside(path, "previous")
    return previous if not path_exists(spark, path) and path_exists(spark, previous) else path


def _written(spark: SparkSession, target: str, write: Callable[[str], None], check: Callable[[str], None]) -> None:
    try:
        write(target)
        check(target)
    except BaseException:
        delete_path(spark, target)
        raise


def replace_dataset(spark: SparkSession, path: str, write: Callable[[str], None], check: Callable[[str], None], versioned: bool = False) -> str:
    """Replace the dataset at ``path`` by what ``write`` puts at the path it is given, once ``check`` has passed it; where the rows are now.

    A write that fails leaves the earlier rows as they were. The new rows are written beside them and take their
    place by two renames, between which ``current_path`` still finds the earlier ones; should the
    writer stop there, the next one puts them back. ``versioned`` keeps each version in a folder of its own below ``path`` and
    switches by the file that names the current one, for file systems whose renames are
    copies; the version before stays for those who still read it. On such a file system,
    an unversioned dataset is deleted first and written in place.
    """
    if versioned:
        earlier, version = current_version(spark, path), uuid.uuid4().hex
        target = f"{path}/{VERSIONS}/{version}"
        _written(spark, target, write, check)
        put_text(spark, f"{path}/{POINTER}", version)
        file_system, folder = hadoop_path(spark, f"{path}/{VERSIONS}")
        for status in file_system.listStatus(folder):
            if status.getPath().getName() not in (version, earlier):
                file_system.delete(status.getPath(), True)
        return target
    if path.partition(":")[0] in OBJECT_STORES:
        delete_path(spark, path)
        write(path)
        check(path)
        return path
    previous, target = _beside(path, "previous"), _beside(path, f"new-{uuid.uuid4().hex}")
    if not path_exists(spark, path) and path_exists(spark, previous):
        _rename(spark, previous, path)
    _written(spark, target, write, check)
    delete_path(spark, previous)
    if path_exists(spark, path):
        _rename(spark, path, previous)
    _rename(spark, target, path)
    delete_path(spark, previous)
    return path


def same_count(path: str, expected: int, found: int) -> None:
    if expected != found:
        raise RowCountMismatch(f"{path} holds {found} of {expected} rows")
