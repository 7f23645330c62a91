"""Stage files: how a table is laid out on a file system, and how to scan it."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stagemart.datasets import current_path, get_text
from stagemart.names import quoted
from stagemart.session import session_setting


@dataclass(frozen=True)
class FileFormat:
    """Format of a stage or mart dataset. The CSV fields have no effect on parquet.

    ``escape`` stands before a quote inside of a quoted value; a quote reads files that double it.

    ``multi_line`` reads CSV records whose quoted values hold line breaks. A file cannot be split
    then: one task streams through it, and ``max_records_per_file`` bounds the files written here.
    Turn it off for large files from elsewhere without such values, or give files that are written
    and read here a ``record_separator``: any character that no value holds. Files of any size are then
    split between tasks, and line breaks are part of values. A value with that character raises
    when it is written.
    """

    file_type: str = "parquet"
    separator: str = ","
    escape: str = "\\"
    header: bool = False
    infer_schema: bool = False
    multi_line: bool = True
    record_separator: str | None = None
    max_records_per_file: int = 1_048_576  # a fixed value

    def __post_init__(self) -> None:
        if self.file_type not in ("parquet", "csv"):
            raise ValueError(f"file type must be parquet or csv, not {self.file_type}")
        if self.record_separator is not None and (len(self.record_separator) != 1 or self.record_separator in "\r\n" + self.separator):
            raise ValueError("a record separator is one character, and neither a line break nor the separator of values")

    @property
    def _csv_options(self) -> dict[str, object]:
        return {"sep": self.separator, "header": self.header, "escape": self.escape, "lineSep": self.record_separator or "\n"}

    @property
    def read_options(self) -> dict[str, object]:
        if self.file_type == "parquet":
            return {}
        # Only a value without quotes is NULL: by default, the reader takes "" for NULL as well.
        return self._csv_options | {
            "inferSchema": self.infer_schema,
            "multiLine": self.multi_line and self.record_separator is None,
            "nullValue": "\0null",
        }

    @property
    def write_options(self) -> dict[str, object]:
        options: dict[str, object] = {"maxRecordsPerFile": self.max_records_per_file}
        if self.file_type == "csv":
            # The writer's defaults strip blanks and cut timestamps to milliseconds.
            options |= self._csv_options | {
                "ignoreLeadingWhiteSpace": False,
                "ignoreTrailingWhiteSpace": False,
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
            }
        return options


#: The file of a CSV dataset that states its schema; readers pass over it.
STATED_SCHEMA = "_schema"
PARQUET = FileFormat()
#: CSV for files that jobs write for themselves: records end in a control character, so that files split.
STAGED_CSV = FileFormat("csv", record_separator="\x1e")


def dataset_path(folder: str, table: str, file_format: FileFormat = PARQUET) -> str:
    return f"{folder.rstrip('/')}/{table}.{file_format.file_type}"


def read_files(
    spark: SparkSession,
    folder: str,
    table: str,
    file_format: FileFormat = PARQUET,
    schema: StructType | None = None,
) -> DataFrame:
    """Scan ``{folder}/{table}.{file_type}``, in the version that is current.

    CSV columns are strings unless the format asks for their types. Files that were written here state them
    (``_schema`` beside them), so that types and names are those that were written; others are inferred, which costs one more pass over
    the files and takes a timestamp without zone for TIMESTAMP_NTZ. With a ``schema`` nothing is
    inferred, values of partition columns included.
    """
    reader = spark.read.format(file_format.file_type).options(**file_format.read_options)
    path = current_path(spark, dataset_path(folder, table, file_format))
    if schema is None and file_format.file_type == "csv" and file_format.infer_schema:
        stated = get_text(spark, f"{path}/{STATED_SCHEMA}")
        if stated is not None:
            schema = StructType.fromJson(json.loads(stated))
            # a header that names other columns raises
            rows = reader.options(inferSchema=False, enforceSchema=not file_format.header).schema(schema).load(path)
            return rows.select([F.col(quoted(name)) for name in schema.names])
    if schema is not None:
        reader = reader.schema(schema)
    if schema is None and file_format.file_type == "csv" and file_format.infer_schema:
        with session_setting(spark, "spark.sql.timestampType", "TIMESTAMP_NTZ"):
            return reader.load(path)
    return reader.load(path)


def register_stage_view(
    spark: SparkSession,
    schema_folder: str,
    schema: str,
    table: str,
    file_format: FileFormat = PARQUET,
) -> DataFrame:
    """Expose one stage table to SQL scripts as the temporary view ``{schema}_{table}``."""
    stage = read_files(spark, schema_folder, table, file_format)
    stage.createOrReplaceTempView(f"{schema}_{table}")
    return stage
