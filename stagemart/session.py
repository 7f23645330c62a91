"""Small helpers around the session the caller passes in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager, nullcontext
from threading import Lock

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    In local mode, where one machine holds all executors, a temporary folder stands in for an
    unset value. On a cluster an unset value is an error, as no local folder would do.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="stagemart-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def new_name(label: str) -> str:
    """A name for a table that no other run in the same catalog uses."""
    return f"{label}_{uuid.uuid4().hex}"


_new_folders: list[str] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """Name a folder under the shared one that no other call uses; ``clear_folders`` deletes it."""
    folder = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _new_folders.append(folder)
    return folder


def clear_folders(spark: SparkSession) -> None:
    """Delete all folders that ``new_folder`` has named in this process, once nothing reads them any more."""
    while _new_folders:
        delete_path(spark, _new_folders.pop())


@contextmanager
def job_description(spark: SparkSession, text: str) -> Iterator[None]:
    """Show ``text`` in the Spark UI for the jobs started inside the block."""
    context = spark.sparkContext
    before = context.getLocalProperty("spark.job.description")
    context.setJobDescription(text)
    try:
        yield
    finally:
        context.setJobDescription(before)


_settings_lock = Lock()
_settings: dict[tuple[int, str], tuple[int, str | None]] = {}


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Set a SQL setting while the block runs; threads inside at one time must agree on the value.

    The first one to enter sets it, and the last one to leave puts back what was there before.
    """
    key = (id(spark), name)
    with _settings_lock:
        inside, before = _settings.get(key, (0, None))
        if inside == 0:
            before = spark.conf.get(name, None)
            spark.conf.set(name, value)
        _settings[key] = (inside + 1, before)
    try:
        yield
    finally:
        with _settings_lock:
            inside, before = _settings.pop(key)
            if inside > 1:
                _settings[key] = (inside - 1, before)
            elif before is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, before)


def session_timezone(spark: SparkSession, name: str | None) -> AbstractContextManager[None]:
    """Work in a time zone while the block runs; None keeps that of the session."""
    return session_setting(spark, "spark.sql.session.timeZone", name) if name else nullcontext()


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(context._jsc.hadoopConfiguration()), found


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme and authority, so that two spellings of one place compare equal."""
    file_system, found = hadoop_path(spark, path)
    return file_system.makeQualified(found).toString()


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete one dataset through its Hadoop file system; False if there was none."""
    file_system, found = hadoop_path(spark, path)
    if found.isRoot():
        raise ValueError(f"refusing to delete {path}")
    return file_system.delete(found, True)
