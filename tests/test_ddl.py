"""External DDL: every line of both type maps."""

import pytest

from stagemart.operators import external_ddl_as_written, external_ddl_oracle, external_ddl_postgres, normalize_decimals


@pytest.fixture
def oracle(spark):
    columns = [
        ("DATE", 7, None, None, "timestamp"),
        ("TIMESTAMP(6)", 11, None, 6, "timestamp"),
        ("VARCHAR2", 30, None, None, "varchar(30)"),
        ("RAW", 16, None, None, "varchar(16)"),
        ("NUMBER", 22, None, None, "decimal(38,10)"),
        ("NUMBER", 22, None, 0, "decimal(38)"),
        ("NUMBER", 22, 38, 0, "decimal(38)"),
        ("NUMBER", 22, 10, 2, "float"),
        ("NUMBER", 22, 10, 0, "float"),
        ("NUMBER", 22, 38, None, "float"),
        ("NUMBER", 22, None, 3, "float"),
        ("CHAR", 3, None, None, "char(3)"),
        ("CLOB", None, None, None, "clob()"),
    ]
    rows = [
        (table, f"C{number}", kind, length, precision, scale, number)
        for table in ("ZED", "Orders")
        for number, (kind, length, precision, scale, _) in reversed(list(enumerate(columns, start=1)))
    ]
    schema = (
        "table_name string, column_name string, data_type string, data_length int, data_precision int,"
        " data_scale int, column_id int"
    )
    return spark.createDataFrame(rows, schema), [(f"c{n}", column[-1]) for n, column in enumerate(columns, start=1)]


def test_oracle(oracle):
    catalog, expected = oracle
    rows = external_ddl_oracle(catalog, "Sales").collect()
    assert [row["table_name"] for row in rows] == ["Orders", "ZED"]
    lines = ",\n".join(f"  {name} {kind}" for name, kind in expected)
    assert rows[0]["ddl"] == (
        f"create external table sales.orders (\n{lines}\n) stored as parquet \n"
        "location 's3://datalake/sales/orders.parquet';"
    )


def test_oracle_tables_in_any_case(oracle):
    rows = external_ddl_oracle(oracle[0], "sales", ["orders"], "s3://other").collect()
    assert [row["table_name"] for row in rows] == ["Orders"]
    assert rows[0]["ddl"].endswith("location 's3://other/sales/orders.parquet';")


def test_postgres(spark):
    kinds = [
        ("character varying", "varchar"),
        ("text", "varchar"),
        ("ARRAY", None),
        ("uuid", "varchar"),
        ("json", "varchar"),
        ("timestamp without time zone", "timestamp"),
        ("numeric", "decimal(38,10)"),
        ("double precision", "decimal(38,10)"),
        ("bigint", "bigint"),
        ("timestamp with time zone", "timestamp with time zone"),
        ("jsonb", "jsonb"),
        ("boolean", "boolean"),
    ]
    rows = [("orders", f"c{number}", kind, number) for number, (kind, _) in enumerate(kinds)]
    rows += [("Orders", "c", "text", 1), ("only_arrays", "a", "ARRAY", 1)]
    catalog = spark.createDataFrame(
        rows[::-1], "table_name string, column_name string, data_type string, ordinal_position int"
    )
    lines = ",\n".join(f"  c{number} {kind}" for number, (_, kind) in enumerate(kinds) if kind)
    found = external_ddl_postgres(catalog, ["orders"]).collect()
    assert [tuple(row) for row in found] == [
        (
            "orders",
            f"create external table datawarehouse.orders(\n{lines}\n) stored as parquet\n"
            "location 's3://datalake/orders.parquet';\n\n",
        )
    ]
    assert [row["table_name"] for row in external_ddl_postgres(catalog).collect()] == ["Orders", "orders"]


def test_as_written_agrees_with_the_files(spark):
    frame = spark.sql(
        """SELECT 1 AS id, CAST(2 AS DECIMAL(10,2)) AS price, CAST(2 AS DECIMAL(38,10)) AS rate, 'a' AS name,
                  TIMESTAMP_NTZ'2024-01-01' AS at, DATE'2024-01-01' AS day, 3L AS n, true AS ok, array(1) AS many"""
    )
    assert external_ddl_as_written("t", normalize_decimals(frame).schema, "datalake", "s3://lake/t.parquet") == (
        "create external table datalake.t(\n  id int,\n  price float,\n  rate decimal(38,10),\n  name varchar,\n"
        "  at timestamp,\n  day date,\n  n bigint,\n  ok boolean\n) stored as parquet\n"
        "location 's3://lake/t.parquet';"
    )
