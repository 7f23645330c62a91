from stagemart.sources.files import FileFormat, PARQUET, dataset_path, read_files, register_stage_view
from stagemart.sources.jdbc import Database, collect_bounds, key_bounds, read_table
from stagemart.sources.metadata import StageMetadata, read_stage_metadata, stage_tables

__all__ = [
    "Database",
    "FileFormat",
    "PARQUET",
    "StageMetadata",
    "collect_bounds",
    "dataset_path",
    "key_bounds",
    "read_files",
    "read_stage_metadata",
    "read_table",
    "register_stage_view",
    "stage_tables",
]
