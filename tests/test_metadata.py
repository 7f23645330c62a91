"""Stage metadata lookup."""

import pytest
from conftest import rows_of

from stagemart.errors import MissingMetadata
from stagemart.sinks import write_table
from stagemart.sources import StageMetadata, read_stage_metadata, stage_tables


@pytest.fixture
def metadata(spark):
    return StageMetadata(
        spark.createDataFrame(
            [("test", "split_col", 2048, 1), ("undated", "id", 8, None), ("dangling", "id", 8, 9)],
            "table_name string, partition_column string, num_partitions int, date_column_id int",
        ),
        spark.createDataFrame([(1, "updated_at"), (2, "unused")], "id int, date_column string"),
    )


def test_tables_without_a_date_column_stay(metadata):
    found = stage_tables(metadata)
    assert found.columns == ["table_name", "partition_column", "num_partitions", "date_column"]
    assert rows_of(found) == [
        ("dangling", "id", 8, None),
        ("test", "split_col", 2048, "updated_at"),
        ("undated", "id", 8, None),
    ]


def test_single_table_in_any_case(metadata):
    assert rows_of(stage_tables(metadata, "TEST")) == [("test", "split_col", 2048, "updated_at")]


def test_nothing_configured_is_an_error(metadata):
    with pytest.raises(MissingMetadata):
        stage_tables(metadata, "other")
    with pytest.raises(MissingMetadata):
        stage_tables(metadata, "x' OR 'a' = 'a")
    with pytest.raises(MissingMetadata):
        stage_tables(StageMetadata(metadata.stage_table.limit(0), metadata.stage_date_column))


def test_metadata_tables_in_a_database(spark, metadata, database):
    write_table(metadata.stage_table, database, "stage_table")
    write_table(metadata.stage_date_column, database, "stage_date_column")
    assert rows_of(stage_tables(read_stage_metadata(spark, database))) == rows_of(stage_tables(metadata))
