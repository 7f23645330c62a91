"""The checked queries: each a function of (session, data folder), most with the SQL to match."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}


def query(name: str, expected: str) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL whose result it must equal."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        EXPECTED[name] = expected
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact_sum(column: str, alias: str) -> Column:
    """Sum of amounts with up to four decimals that does not depend on the order of the rows.

    Whole ten-thousandths are added up: far cheaper than turning each amount into a decimal.
    """
    parts = F.rint(F.col(column) * 10_000).cast("bigint")
    return (F.sum(parts.cast("decimal(19,0)")).cast("double") / 10_000).alias(alias)
