"""External-table DDL from a column catalog, one statement per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Where the external tables lie, and the types they declare. The layout of the
# statements further down is fixed as well.
DEFAULT_LOCATION = "s3://datalake"
POSTGRES_TYPES = {
    "character varying": "varchar",
    "text": "varchar",
    "uuid": "varchar",
    "json": "varchar",
    "timestamp without time zone": "timestamp",
    "numeric": "decimal(38,10)",
    "double precision": "decimal(38,10)",
}
ORACLE_SIZED_TYPES = {"VARCHAR2": "VARCHAR", "RAW": "VARCHAR"}


def _sized(type_name: Column) -> Column:
    return F.concat(type_name, F.lit("("), F.coalesce(F.col("data_length").cast("string"), F.lit("")), F.lit(")"))


def _oracle_type() -> Column:
    name, precision, scale = F.col("data_type"), F.col("data_precision"), F.col("data_scale")
    number = (
        F.when(precision.isNull() & scale.isNull(), "DECIMAL(38,10)")
        .when(precision.isNull() & (scale == 0), "DECIMAL(38)")
        .when((precision == 38) & (scale == 0), "DECIMAL(38)")
        .otherwise("FLOAT")
    )
    return (
        F.when((name == "DATE") | name.startswith("TIMESTAMP"), "TIMESTAMP")
        .when(name == "NUMBER", number)
        .otherwise(_sized(_mapped(name, ORACLE_SIZED_TYPES)))
    )


def _mapped(name: Column, types: Mapping[str, str]) -> Column:
    pairs = [F.lit(text) for pair in types.items() for text in pair]
    return F.coalesce(F.create_map(*pairs)[name], name)


def _statements(columns: DataFrame, head: Column, tail: Column) -> DataFrame:
    """Put ``  name type`` lines, in order, between a head and a tail per table.

    The lines of a table meet in one group, which the number of its columns bounds.
    """
    lines = F.expr("listagg(concat('  ', column_name, ' ', target_type), ',\\n') WITHIN GROUP (ORDER BY position)")
    return (
        columns.groupBy("table_name")
        .agg(lines.alias("lines"))
        .select("table_name", F.concat(head, F.col("lines"), tail).alias("ddl"))
        .orderBy("table_name")
    )


def external_ddl_oracle(
    catalog: DataFrame, owner: str, tables: Sequence[str] | None = None, location: str = DEFAULT_LOCATION
) -> DataFrame:
    """``(table_name, ddl)`` for an Oracle catalog, all in lower case.

    ``catalog(table_name, column_name, data_type, data_length, data_precision, data_scale,
    column_id)``; ``tables`` are matched whatever their case.
    """
    if tables is not None:
        catalog = catalog.filter(F.lower("table_name").isin([name.lower() for name in tables]))
    columns = catalog.select(
        "table_name", "column_name", _oracle_type().alias("target_type"), F.col("column_id").alias("position")
    )
    head = F.concat(F.lit(f"create external table {owner}."), F.col("table_name"), F.lit(" (\n"))
    tail = F.concat(
        F.lit(f"\n) stored as parquet \nlocation '{location}/{owner}/"), F.col("table_name"), F.lit(".parquet';")
    )
    return _statements(columns, head, tail).select("table_name", F.lower("ddl").alias("ddl"))


def external_ddl_postgres(
    catalog: DataFrame,
    tables: Sequence[str] | None = None,
    schema: str = "datawarehouse",
    location: str = DEFAULT_LOCATION,
) -> DataFrame:
    """``(table_name, ddl)`` for a Postgres catalog; array columns are left out.

    ``catalog(table_name, column_name, data_type, ordinal_position)``.
    """
    if tables is not None:
        catalog = catalog.filter(F.col("table_name").isin(list(tables)))
    columns = catalog.filter(F.col("data_type") != "ARRAY").select(
        "table_name",
        "column_name",
        _mapped(F.col("data_type"), POSTGRES_TYPES).alias("target_type"),
        F.col("ordinal_position").alias("position"),
    )
    head = F.concat(F.lit(f"create external table {schema}."), F.col("table_name"), F.lit("(\n"))
    tail = F.concat(
        F.lit(f"\n) stored as parquet\nlocation '{location}/"), F.col("table_name"), F.lit(".parquet';\n\n")
    )
    return _statements(columns, head, tail)


def _written_type(data_type: DataType) -> str | None:
    if isinstance(data_type, ArrayType):
        return None
    if isinstance(data_type, DecimalType):
        return f"decimal({data_type.precision},{data_type.scale})"
    if isinstance(data_type, (DoubleType, FloatType)):
        return "float"
    if isinstance(data_type, StringType):
        return "varchar"
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        return "timestamp"
    return data_type.simpleString()


def external_ddl_as_written(table: str, schema: StructType, database: str, location: str) -> str:
    """The statement for one dataset by the types its files hold, so that DDL and data agree.

    Pass the schema after ``normalize_decimals``; array columns are left out.
    """
    typed = [(field.name, _written_type(field.dataType)) for field in schema]
    lines = ",\n".join(f"  {name} {type_name}" for name, type_name in typed if type_name is not None)
    return f"create external table {database}.{table}(\n{lines}\n) stored as parquet\nlocation '{location}';"
