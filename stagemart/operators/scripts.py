"""Dimension and fact scripts: one SELECT statement per file."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def read_script(folder: str | Path, project: str, country: str, file_name: str) -> str:
    """Text of ``{folder}/{project}/{country}/{file_name}``.

    Line breaks stay: without them a ``--`` comment would swallow the rest of the statement.
    """
    return (Path(folder) / project / country / file_name).read_text(encoding="utf-8")


def run_script(spark: SparkSession, text: str, name: str) -> DataFrame:
    """Run one script and expose its result as the temporary view ``name`` to later scripts."""
    result = spark.sql(text)
    result.createOrReplaceTempView(name)
    return result
