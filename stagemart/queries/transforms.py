"""Queries over the projections, the series, the advisor and the DDL generators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, TimestampNTZType

from stagemart.functions.series import expand_series, explode_series, register_series
from stagemart.operators.advisor import advise_partitions
from stagemart.operators.ddl import external_ddl_as_written, external_ddl_oracle, external_ddl_postgres
from stagemart.operators.decimals import normalize_decimals
from stagemart.operators.slices import slice_predicates
from stagemart.queries.registry import query, table

# ---- decimals --------------------------------------------------------------------------------


@query(
    "xf_decimal_normalize",
    """
    SELECT CAST(CAST(l_orderkey AS DECIMAL(38,0)) AS VARCHAR) AS order_key,
           CAST(CAST(l_quantity AS DECIMAL(38,10)) AS VARCHAR) AS quantity,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
           CAST(CAST(l_tax AS DECIMAL(4,2)) AS DOUBLE) AS tax,
           l_shipdate
    FROM lineitem
    """,
)
def xf_decimal_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("decimal(38,0)").alias("order_key"),
        F.col("l_quantity").cast("decimal(38,10)").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"),
        "l_shipdate",
    )
    normalized = normalize_decimals(lines)
    # As text, the two that were kept show all digits of their scale.
    kept = {name: F.col(name).cast("string") for name in ("order_key", "quantity")}
    return normalized.withColumns(kept)


# ---- series ----------------------------------------------------------------------------------


def _order_spans(spark: SparkSession, sf_dir: str, days: int, before: int) -> DataFrame:
    """Orders with a second date up to ``days`` later, or up to ``before`` days earlier."""
    span = f"o_orderdate + make_dt_interval(int(o_custkey % {days + before}) - {before})"
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.expr(span).alias("until"))


def _order_series(days: int, before: int, step: str) -> str:
    stop = f"o_orderdate + to_days(CAST(o_custkey % {days + before} AS INTEGER) - {before})"
    return f"""
    SELECT o_orderkey, unnest(generate_series(o_orderdate, {stop}, INTERVAL {step})) AS series FROM orders
    """


def _series_query(name: str, days: int, before: int, interval: str, value: int) -> None:
    @query(name, _order_series(days, before, f"{value} {interval}"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_series(spark)
        spans = _order_spans(spark, sf_dir, days, before)
        return explode_series(spans, "o_orderdate", "until", interval, value).select("o_orderkey", "series")


_series_query("xf_series_months", 380, 20, "months", 1)
_series_query("xf_series_quarters", 1480, 20, "months", 3)
_series_query("xf_series_years", 3980, 20, "years", 1)
_series_query("xf_series_weeks", 80, 10, "weeks", 2)
_series_query("xf_series_days", 15, 5, "days", 1)


@query(
    "xf_series_hours",
    """
    SELECT event_id,
           unnest(generate_series(ts, ts + to_hours(CAST(user_id % 50 AS INTEGER) - 5), INTERVAL 7 HOURS)) AS series
    FROM events
    """,
)
def xf_series_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_series(spark)
    until = F.expr("ts + make_dt_interval(0, int(user_id % 50) - 5)")
    spans = table(spark, sf_dir, "events").select("event_id", "ts", until.alias("until"))
    return explode_series(spans, "ts", "until", "hours", 7).select("event_id", "series")


@query(
    "xf_calendar",
    """
    SELECT day, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
           CAST(day(day) AS INTEGER) AS day_of_month
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS day FROM orders)
    """,
)
def xf_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_series(spark)
    ends = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"))
    return explode_series(ends, "low", "high", "days", 1, "day").select(
        "day", F.year("day").alias("year"), F.month("day").alias("month"), F.day("day").alias("day_of_month")
    )


@query("udf_generate_series", _order_series(380, 20, "1 MONTH"))
def udf_generate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_series(spark)
    _order_spans(spark, sf_dir, 380, 20).createOrReplaceTempView("order_spans")
    return spark.sql(
        """
        SELECT o_orderkey, series
        FROM (SELECT o_orderkey, generate_series(o_orderdate, until) AS dates FROM order_spans)
        LATERAL VIEW OUTER explode(dates) AS series
        WHERE series IS NOT NULL
        """
    )


@query("udf_generate_series_exploded", _order_series(380, 20, "1 MONTH"))
def udf_generate_series_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    _order_spans(spark, sf_dir, 380, 20).createOrReplaceTempView("order_spans")
    return spark.sql(expand_series(spark, "SELECT o_orderkey, explode(generate_series(o_orderdate, until)) AS series FROM order_spans"))


# ---- partition advisor -----------------------------------------------------------------------

_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey", "events": "ts"}
_DOUBLINGS = ", ".join(f"({2 ** power})" for power in range(1, 63))


def _key_number(name: str) -> str:
    return f"epoch_us({_KEYS[name]})" if name == "events" else _KEYS[name]


def _advice(name: str, first_only: bool) -> str:
    number = f"(k - lo) * CAST(n AS HUGEINT) "
    if first_only:
        largest = f"SELECT n, count(CASE WHEN {number} <= hi - lo THEN 1 END) AS held FROM spread, steps GROUP BY n"
    else:
        slice_number = f"greatest(({number} + (hi - lo) - 1) // (hi - lo), 1)"
        largest = f"""
            SELECT n, max(held) AS held
            FROM (SELECT n, {slice_number} AS slice, count(*) AS held FROM spread, steps GROUP BY ALL) GROUP BY n"""
    return f"""
    SELECT '{name}' AS table_name, min(n) AS num_partitions
    FROM (
        WITH keys AS (SELECT {_key_number(name)} AS k FROM {name}),
             spread AS (SELECT k, (SELECT min(k) FROM keys) AS lo, (SELECT max(k) FROM keys) AS hi FROM keys),
             steps AS (SELECT CAST(n AS BIGINT) AS n FROM (VALUES {_DOUBLINGS}) v(n))
        {largest}
    ) WHERE held <= 5000
    """


def _advice_for_all(first_only: bool) -> str:
    parts = " UNION ALL ".join(f"SELECT * FROM ({_advice(name, first_only)})" for name in _KEYS)
    return f"""
    SELECT table_name, num_partitions,
           'update stage.stage_table set num_partitions=' || num_partitions || ' where table_name='''
           || table_name || ''';' AS metadata_update
    FROM ({parts})
    """


@query("adv_num_partitions", _advice_for_all(first_only=True))
def adv_num_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advise_partitions({name: (table(spark, sf_dir, name), key) for name, key in _KEYS.items()})


@query("adv_largest_slice", _advice_for_all(first_only=False))
def adv_largest_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: (table(spark, sf_dir, name), key) for name, key in _KEYS.items()}
    return advise_partitions(tables, basis="largest")


@query(
    "adv_equal_slices",
    """
    WITH keys AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY ALL),
    placed AS (SELECT k, n, sum(n) OVER (ORDER BY k) AS up_to, sum(n) OVER () AS total FROM keys),
    ends AS (SELECT k FROM placed WHERE up_to * 16 // total > (up_to - n) * 16 // total AND up_to < total)
    SELECT slice, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(k * n) AS BIGINT) AS key_sum
    FROM (SELECT k, n, (SELECT count(*) FROM ends WHERE ends.k < keys.k) AS slice FROM keys) GROUP BY slice
    """,
)
def adv_equal_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen slices of lineitem by its key, each read by its predicate."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey")
    parts = [
        lineitem.where(said).select(F.lit(number).cast("bigint").alias("slice"), "l_orderkey")
        for number, said in enumerate(slice_predicates(lineitem, "l_orderkey", 16))
    ]
    return reduce(DataFrame.union, parts).groupBy("slice").agg(F.count("*").alias("n_rows"), F.sum("l_orderkey").alias("key_sum"))


# ---- external DDL ----------------------------------------------------------------------------

_DDL_TABLES = {
    "orders": [
        ("o_orderkey", "bigint"),
        ("o_custkey", "bigint"),
        ("o_orderstatus", "string"),
        ("o_totalprice", "double"),
        ("o_orderdate", "timestamp"),
        ("o_orderpriority", "string"),
    ],
    "lineitem": [
        ("l_orderkey", "bigint"),
        ("l_partkey", "bigint"),
        ("l_suppkey", "bigint"),
        ("l_linenumber", "int"),
        ("l_quantity", "double"),
        ("l_extendedprice", "double"),
        ("l_discount", "double"),
        ("l_tax", "double"),
        ("l_returnflag", "string"),
        ("l_linestatus", "string"),
        ("l_shipdate", "timestamp"),
    ],
    "events": [
        ("event_id", "bigint"),
        ("ts", "timestamp"),
        ("user_id", "bigint"),
        ("event_type", "string"),
        ("value", "double"),
        ("props", "string"),
    ],
    "embeddings": [("vec_id", "bigint"), ("embedding", "array"), ("label", "int")],
}


def _catalog(profiles: list[DataFrame]) -> DataFrame:
    catalog = profiles[0]
    for profile in profiles[1:]:
        catalog = catalog.unionByName(profile)
    return catalog.select(F.inline("columns"))


def oracle_catalog(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """Column catalog of the tables as an Oracle source would hold them, told from all their values.

    Text of one length is CHAR, other text VARCHAR2 of its greatest length; numbers without
    fraction are NUMBER(38,0), others NUMBER(15,2); timestamps at midnight are DATE.
    """
    profiles = []
    for name in names:
        frame, columns = table(spark, sf_dir, name), []
        for position, field in enumerate(frame.schema, start=1):
            column, kind = F.col(field.name), field.dataType
            length = precision = scale = F.lit(None)
            if isinstance(kind, StringType):
                length = F.max(F.length(column))
                type_name = F.when(F.min(F.length(column)) == length, "CHAR").otherwise("VARCHAR2")
            elif isinstance(kind, TimestampNTZType):
                type_name = F.when(F.every(column == column.cast("date")), "DATE").otherwise("TIMESTAMP(6)")
            else:
                type_name = F.lit("NUMBER")
                if isinstance(kind, DoubleType):
                    whole = F.every(column == F.floor(column))
                    precision, scale = F.when(whole, 38).otherwise(15), F.when(whole, 0).otherwise(2)
                elif isinstance(kind, IntegerType):
                    scale = F.lit(0)
            columns.append(
                F.struct(
                    F.lit(name.upper()).alias("table_name"),
                    F.lit(field.name.upper()).alias("column_name"),
                    type_name.alias("data_type"),
                    length.cast("int").alias("data_length"),
                    precision.cast("int").alias("data_precision"),
                    scale.cast("int").alias("data_scale"),
                    F.lit(position).alias("column_id"),
                )
            )
        profiles.append(frame.agg(F.array(*columns).alias("columns")))
    return _catalog(profiles)


def postgres_catalog(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """The same for a Postgres source: text that always starts with a brace is json.

    Whole numbers that all fit 32 bits are integer, timestamps that are all at midnight are date.
    """
    kinds = {IntegerType(): "integer", DoubleType(): "double precision"}
    profiles = []
    for name in names:
        frame, columns = table(spark, sf_dir, name), []
        for position, field in enumerate(frame.schema, start=1):
            column, kind = F.col(field.name), field.dataType
            if isinstance(kind, StringType):
                json, sized = F.every(column.startswith("{")), F.max(F.length(column)) <= 30
                type_name = F.when(json, "json").when(sized, "character varying").otherwise("text")
            elif isinstance(kind, TimestampNTZType):
                midnight = F.every(column == column.cast("date"))
                type_name = F.when(midnight, "date").otherwise("timestamp without time zone")
            elif isinstance(kind, LongType):
                narrow = (F.min(column) >= -(2**31)) & (F.max(column) < 2**31)
                type_name = F.when(narrow, "integer").otherwise("bigint")
            elif isinstance(kind, ArrayType):
                type_name = F.lit("ARRAY")
            else:
                type_name = F.lit(kinds[kind])
            columns.append(
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(field.name).alias("column_name"),
                    type_name.alias("data_type"),
                    F.lit(position).alias("ordinal_position"),
                )
            )
        profiles.append(frame.agg(F.array(*columns).alias("columns")))
    return _catalog(profiles)


def _oracle_line(column: str, kind: str) -> str:
    if kind == "string":
        return f"""CASE WHEN min(length({column})) = max(length({column})) THEN 'char(' ELSE 'varchar(' END
                   || max(length({column})) || ')'"""
    if kind == "double":
        return f"CASE WHEN bool_and({column} = floor({column})) THEN 'decimal(38)' ELSE 'float' END"
    return {"bigint": "'decimal(38,10)'", "int": "'decimal(38)'", "timestamp": "'timestamp'"}[kind]


def _postgres_line(column: str, kind: str) -> str:
    if kind == "bigint":
        return f"CASE WHEN min({column}) >= -2147483648 AND max({column}) <= 2147483647 THEN 'integer' ELSE 'bigint' END"
    if kind == "timestamp":
        return f"CASE WHEN bool_and({column} = date_trunc('day', {column})) THEN 'date' ELSE 'timestamp' END"
    return {"int": "'integer'", "double": "'decimal(38,10)'", "string": "'varchar'"}[kind]


def _ddl(names: list[str], line: object, upper: bool, head: str, tail: str) -> str:
    statements = []
    for name in names:
        columns = [(column, kind) for column, kind in _DDL_TABLES[name] if kind != "array"]
        lines = " || ',' || chr(10) || ".join(f"'  {column} ' || {line(column, kind)}" for column, kind in columns)
        shown = name.upper() if upper else name
        begin, end = head.format(name=name), tail.format(name=name)
        statements.append(f"SELECT '{shown}' AS table_name, {begin} || {lines} || {end} AS ddl FROM {name} HAVING count(*) >= 0")
    return " UNION ALL ".join(f"SELECT * FROM ({statement})" for statement in statements)


@query(
    "ddl_oracle",
    _ddl(
        ["orders", "lineitem", "events"],
        _oracle_line,
        True,
        "'create external table sales.{name} (' || chr(10)",
        "chr(10) || ') stored as parquet ' || chr(10) || 'location ''s3://datalake/sales/{name}.parquet'';'",
    ),
)
def ddl_oracle(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = oracle_catalog(spark, sf_dir, ["orders", "lineitem", "events"])
    return external_ddl_oracle(catalog, "SALES", tables=["orders", "LineItem", "EVENTS"])


@query(
    "ddl_postgres",
    _ddl(
        ["orders", "lineitem", "events", "embeddings"],
        _postgres_line,
        False,
        "'create external table datawarehouse.{name}(' || chr(10)",
        "chr(10) || ') stored as parquet' || chr(10) || 'location ''s3://datalake/{name}.parquet'';'"
        " || chr(10) || chr(10)",
    ),
)
def ddl_postgres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return external_ddl_postgres(postgres_catalog(spark, sf_dir, ["orders", "lineitem", "events", "embeddings"]))


_WRITTEN = {"bigint": "bigint", "int": "int", "double": "float", "timestamp": "timestamp", "string": "varchar"}


def _written_line(column: str, kind: str) -> str:
    """Types as written, but for key columns: decimals wide enough for their values, of which XF1 keeps one."""
    if column.endswith("key"):
        return f"CASE WHEN max({column}) < 1000 THEN 'float' ELSE 'decimal(38,0)' END"
    return f"'{_WRITTEN[kind]}'"


@query(
    "ddl_as_written",
    _ddl(
        ["orders", "lineitem", "events", "embeddings"],
        _written_line,
        False,
        "'create external table mart.{name}(' || chr(10)",
        "chr(10) || ') stored as parquet' || chr(10) || 'location ''s3://datalake/mart/{name}.parquet'';'",
    ),
)
def ddl_as_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statements that fit the files as the sink writes them; key columns go in as decimals.

    A key column whose values need three digits at most is DECIMAL(3,0), which the sink turns into
    a double; others are DECIMAL(38,0), which it keeps.
    """
    statements = []
    for name in ("orders", "lineitem", "events", "embeddings"):
        frame = table(spark, sf_dir, name)
        keys = [column for column in frame.columns if column.endswith("key")]
        ends = frame.agg(*(F.max(column).alias(column) for column in keys)).first() if keys else {}
        narrow = {column: ends[column] is not None and ends[column] < 1000 for column in keys}
        typed = {column: F.col(column).cast("decimal(3,0)" if narrow[column] else "decimal(38,0)") for column in keys}
        written = normalize_decimals(frame.withColumns(typed))
        text = external_ddl_as_written(name, written.schema, "mart", f"s3://datalake/mart/{name}.parquet")
        statements.append(spark.range(1).select(F.lit(name).alias("table_name"), F.lit(text).alias("ddl")))
    return reduce(DataFrame.unionByName, statements)
