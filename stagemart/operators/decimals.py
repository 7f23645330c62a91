"""Decimal normalization before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructType

from stagemart.names import quoted

# The decimal types that external tables can declare.
KEPT_DECIMALS = (DecimalType(38, 10), DecimalType(38, 0))


def _becomes_double(data_type: DataType) -> bool:
    return isinstance(data_type, DecimalType) and data_type not in KEPT_DECIMALS


def normalize_decimals(frame: DataFrame) -> DataFrame:
    """Cast every top-level decimal column to double, but for decimal(38,10) and decimal(38,0)."""
    fields = frame.schema.fields
    if not any(_becomes_double(field.dataType) for field in fields):
        return frame
    columns = []
    for field in fields:
        column = F.col(quoted(field.name))
        if _becomes_double(field.dataType):
            column = column.cast("double").alias(field.name)
        columns.append(column)
    return frame.select(columns)


def same_types(left: StructType, right: StructType) -> bool:
    """True if both schemas hold the same columns and types, whatever their nullability."""
    return [(f.name, f.dataType) for f in left] == [(f.name, f.dataType) for f in right]
