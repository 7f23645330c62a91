"""The queries against SQL on whole tables, and what they must say whatever the table."""

import duckdb
import pytest

import __spark_entry__ as checks
from stagemart.llm.queries import LLM_EXPECTED, LLM_QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "conversations")


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def tables(request):
    folder = f"/root/testdata/{request.param}"
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return folder, connection


@pytest.mark.parametrize("name", sorted(LLM_EXPECTED))
def test_query_equals_sql(spark, tables, name):
    folder, connection = tables
    frame = LLM_QUERIES[name](spark, folder)
    expected = connection.execute(LLM_EXPECTED[name])
    columns = [column[0] for column in expected.description]
    rows = expected.fetchall()
    assert rows and sorted(frame.columns) == sorted(columns)
    assert sorted(frame.select(*columns).collect(), key=repr) == sorted(map(tuple, rows), key=repr)


def test_all_operators_and_the_pipeline_are_registered():
    names = checks.queries().keys()
    assert {int(name[2:].split("_")[0]) for name in LLM_QUERIES} == set(range(1, 14))
    assert names >= LLM_QUERIES.keys() and "pipeline" in names
    assert checks.oracle_sql().keys() <= names
