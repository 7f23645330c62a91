"""Every registered query against the SQL it must equal, on whole tables."""

import pytest
from conftest import SMALLEST

import __spark_entry__ as checks
from stagemart.queries import EXPECTED, QUERIES


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda position: columns[position])
    return sorted(tuple(repr(row[position]) for position in order) for row in rows)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == EXPECTED.keys()
    assert checks.queries().keys() >= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SMALLEST)
    expected = duck.execute(EXPECTED[name])
    columns = [column[0] for column in expected.description]
    rows = expected.fetchall()
    assert rows
    assert sorted(frame.columns) == sorted(columns)
    assert _sorted_rows(frame.collect(), frame.columns) == _sorted_rows(rows, columns)


def test_entry_is_the_flagship(spark):
    frame = checks.entry(spark)
    assert frame.columns == ["company", "brand", "n_lines", "sales_amount", "payment_amount"]
    assert frame.count() == 621
