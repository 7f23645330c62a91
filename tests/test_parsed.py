"""What Spark's parser tells of a script."""

import pytest

from stagemart.errors import DependencyCycle
from stagemart.functions import expand_series, register_series
from stagemart.operators.parsed import ParsedScript, dependency_levels


@pytest.mark.parametrize(
    "text, relations",
    [
        ("SELECT 1", set()),
        ("SELECT * FROM a JOIN s.B ON a.x = b.x -- FROM c", {"a", "s.b"}),
        ("SELECT 'FROM x' FROM `odd name`, LATERAL (SELECT * FROM inner_one)", {"odd name", "inner_one"}),
        ("WITH a AS (SELECT * FROM a), b AS (SELECT * FROM a) SELECT * FROM b, c", {"a", "c"}),
        ("SELECT (SELECT max(x) FROM m) FROM t WHERE EXISTS (SELECT 1 FROM e) AND k IN (SELECT k FROM i)", {"m", "t", "e", "i"}),
        ("SELECT * FROM t WHERE k IN (WITH t AS (SELECT * FROM u) SELECT k FROM t)", {"t", "u"}),
        ("SELECT * FROM a UNION ALL SELECT * FROM b EXCEPT SELECT * FROM (SELECT * FROM c) d", {"a", "b", "c"}),
        ("WITH RECURSIVE r AS (SELECT 1 AS n UNION ALL SELECT n + 1 FROM r WHERE n < 3) SELECT * FROM r, s", {"s"}),
    ],
)
def test_relations(spark, text, relations):
    assert ParsedScript(spark, text).relations() == relations


def test_levels():
    assert dependency_levels({"f": {"D1", "d2", "stage"}, "d1": {"stage"}, "d2": {"d1"}, "g": set()}) == [["d1", "g"], ["d2"], ["f"]]
    for reads in ({"a": {"a"}}, {"a": {"b"}, "b": {"c"}, "c": {"a"}, "d": set()}):
        with pytest.raises(DependencyCycle):
            dependency_levels(reads)


def test_calls_are_found_where_spark_sees_them(spark):
    text = "SELECT Generate_Series(a.b, (x), 'f(1)'), 'generate_series(1)' -- generate_series(2)\nFROM t WHERE k IN (SELECT generate_series(series_to => 2, series_from => 1)[0] FROM u)"
    one, other = ParsedScript(spark, text).calls("generate_series")
    assert (one.arguments, text[one.start : one.end]) == (("a.b", "x", "'f(1)'"), "Generate_Series(a.b, (x), 'f(1)')")
    assert other.named == {"series_from": "1", "series_to": "2"} and not other.arguments


CALLS = [
    "generate_series(low, high)", "generate_series(low, high, 'days', '9')", "generate_series(series_to => high, series_from => low)",
    "generate_series(low, generate_series(low, high, 'weeks')[1], unit)", "generate_series(CAST(low AS DATE), high + INTERVAL 1 DAY, concat('mon', 'ths'), cast(1 + 1 AS STRING))",
]


@pytest.mark.parametrize("call", CALLS)
def test_expanded_calls_are_the_function(spark, call):
    register_series(spark)
    # columns named as the steps of the expression might be, and starts after the 28th
    spark.sql(
        """SELECT id, TIMESTAMP_NTZ'2023-12-29 10:00:00' + make_dt_interval(id) AS low, TIMESTAMP_NTZ'2024-06-30 10:00:00' AS high,
                  IF(id % 2 = 0, 'months', 'days') AS unit, id AS d, id AS dates, id AS i, id AS run FROM range(6)
           UNION ALL SELECT 9, NULL, TIMESTAMP_NTZ'2024-06-30', 'days', 1, 1, 1, 1"""
    ).createOrReplaceTempView("spans")
    plain = spark.sql(f"SELECT id, {call} AS s FROM spans")
    expected = sorted((row.id, moment) for row in plain.collect() for moment in row.s or [])
    exploded = spark.sql(expand_series(spark, f"SELECT id, explode({call}) AS s FROM spans"))
    assert sorted(map(tuple, exploded.collect())) == expected and len(expected) > 10
    assert "Python" not in exploded._jdf.queryExecution().executedPlan().toString()
    lateral = spark.sql(expand_series(spark, f"SELECT id, s FROM spans LATERAL VIEW explode({call}) e AS s"))
    assert sorted(map(tuple, lateral.collect())) == expected


def test_scripts_without_a_call_are_left_alone(spark):
    text = "SELECT 'generate_series(1, 2)' /* generate_series(1, 2) */ FROM t"
    assert expand_series(spark, text) == text
    with pytest.raises(ValueError, match="wrong arguments"):
        expand_series(spark, "SELECT generate_series(1)")
