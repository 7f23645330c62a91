"""Slices of equal count on skewed keys."""

import pytest

from stagemart.operators.slices import cut_points, slice_predicates

FRAMES = {
    "even": "SELECT id AS k FROM range(1000)",
    "a third on one key": "SELECT IF(id % 3 = 0, 500, id) AS k FROM range(3000)",
    "crowded at the start": "SELECT CAST(pow(id / 100.0, 4) AS BIGINT) AS k FROM range(3000)",
    "nulls": "SELECT IF(id < 900, NULL, id) AS k FROM range(1000)",
    "one key": "SELECT 7 AS k FROM range(100)",
    "text": "SELECT concat('it''s \\\\ ', id % 90) AS k FROM range(1000)",
    "dates": "SELECT DATE'2024-01-01' + CAST(id % 50 AS INT) AS k FROM range(1000)",
    "moments": "SELECT TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, 0, id) AS k FROM range(1000)",
    "fractions": "SELECT CAST(id / 8 AS DECIMAL(20,3)) AS k FROM range(1000)",
    "empty": "SELECT id AS k FROM range(0)",
}


@pytest.mark.parametrize("name", FRAMES)
@pytest.mark.parametrize("slices", [1, 8])
def test_each_row_is_in_one_slice_of_its_share(spark, name, slices):
    frame = spark.sql(FRAMES[name]).repartition(5)
    predicates = slice_predicates(frame, "k", slices)
    counts = [frame.where(said).count() for said in predicates]
    assert sum(counts) == frame.count() and len(predicates) <= slices
    held = {row.k: row["count"] for row in frame.where("k IS NOT NULL").groupBy("k").count().collect()}
    total, most = sum(held.values()), max(held.values(), default=0)
    within = [frame.where(f"k IS NOT NULL AND ({said})").count() for said in predicates]
    assert max(within, default=0) < total / slices + most + 1
    if name in ("even", "fractions", "moments"):
        assert len(predicates) == slices and max(within) - min(within) <= 1


def test_a_hot_key_ends_a_slice(spark):
    frame = spark.sql(FRAMES["a third on one key"])
    assert "500" in cut_points(frame, "k", 12)


def test_what_cannot_be_sliced(spark):
    with pytest.raises(TypeError):
        slice_predicates(spark.sql("SELECT array(1) AS k"), "k", 2)
    with pytest.raises(ValueError):
        cut_points(spark.range(3), "id", 0)
