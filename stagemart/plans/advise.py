"""Advice job: partition counts for every configured stage table, from the source database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stagemart.operators.advisor import DEFAULT_THRESHOLD, advise_partitions, number_bounds
from stagemart.sources.jdbc import DEFAULT_NUM_PARTITIONS, Database, collect_bounds, key_bounds, read_table
from stagemart.sources.metadata import StageMetadata, stage_tables


def advise_stage_tables(
    spark: SparkSession,
    source: Database,
    metadata: StageMetadata,
    metadata_schema: str,
    threshold: int = DEFAULT_THRESHOLD,
    basis: str = "first",
) -> DataFrame:
    """``advise_partitions`` over the tables of a project, read as its metadata says so far.

    The bounds come from one statement a table and are not computed again. Only the keys leave the
    database: for ``first`` the lower half of them, for ``largest`` all.
    """
    tables, known = {}, {}
    for row in stage_tables(metadata).collect():
        table, key = row["table_name"].lower(), row["partition_column"].lower()
        ends = key_bounds(spark, source, table, key)
        bounds, known[table] = collect_bounds(ends), number_bounds(ends)
        slices = row["num_partitions"] or DEFAULT_NUM_PARTITIONS
        tables[table] = (read_table(spark, source, table, key, slices, bounds), key)
    return advise_partitions(tables, threshold, basis, metadata_schema, known)
