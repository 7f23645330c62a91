"""Intermediate tables of a job, written to the folder all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from stagemart.session import delete_path, new_folder


class Scratch:
    """Written tables of one operator call under ``spark.checkpoint.dir``; they cut lineage and outlive executors.

    What the returned frame still reads stays until the caller deletes ``folder``; the rest goes
    as soon as it has been used.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = new_folder(spark, label)
        self._kept: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, frame: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
        path = f"{self.folder}/{len(self._kept):03d}-{label}"
        (frame.write.partitionBy(partition_by) if partition_by else frame.write).parquet(path)
        kept = self.spark.read.schema(frame.schema).parquet(path)
        self._kept[id(kept)] = kept, path
        return kept

    def keep_observed(self, frame: DataFrame, label: str, **measures: Column) -> tuple[DataFrame, dict]:
        """The same, with aggregates taken while the rows are written, so that no job of their own is needed."""
        observed = Observation()
        named = [measure.alias(name) for name, measure in measures.items()]
        return self.keep(frame.observe(observed, *named), label), observed.get

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            delete_path(self.spark, self._kept[id(frame)][1])
