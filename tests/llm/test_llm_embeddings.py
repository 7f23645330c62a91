"""Near vectors against all pairs."""

import math

import numpy as np
import pytest

from stagemart.llm.embeddings import EmbeddingOptions, near_vectors


def _expected(rows, cosine=0.95):
    able = []
    for number, (ident, vector) in enumerate(rows):
        if ident is None or not vector or any(each is None or not math.isfinite(each) for each in vector):
            continue
        wide = np.array(vector, float)
        if wide @ wide > 0:
            able.append((number, ident, wide))
    links = [0] * len(rows)
    parent = {ident: ident for ident, _ in rows}

    def top(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for at, (a, one, x) in enumerate(able):
        for b, other, y in able[:at]:
            if len(x) == len(y) and x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= cosine:
                links[a] += 1
                links[b] += 1
                low, high = sorted((top(one), top(other)))
                parent[high] = low
    return sorted(
        ((ident, links[number], None if ident is None else top(ident), None if ident is None else top(ident) == ident) for number, (ident, _) in enumerate(rows)),
        key=repr,
    )


def _vectors(dims, count, seed):
    random = np.random.default_rng(seed)
    base = random.normal(size=(12, dims))
    found = []
    for number in range(count):
        spread = random.choice([0.0, 0.05, 0.15, 0.2, 0.25, 0.3, 1.5])
        vector = base[random.integers(0, 12)] + spread * random.normal(size=dims)
        found.append((number * 3 % 1009, (vector * random.choice([1.0, 4.0])).astype(np.float32).tolist()))
    return found


@pytest.mark.parametrize("dims, options", [(64, EmbeddingOptions()), (64, EmbeddingOptions(tile_rows=20)), (40, EmbeddingOptions(block_dims=4, tile_rows=50)), (5, EmbeddingOptions()), (1, EmbeddingOptions())])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_links_and_components_equal_all_pairs(spark, dims, options, kind):
    rows = _vectors(dims, 260, dims)
    rows += [rows[0], rows[0], (5000, rows[0][1]), (None, rows[0][1]), (5001, None), (5002, []), (5003, [0.0] * dims), (5004, [None] + [1.0] * (dims - 1)), (5005, [math.nan] * dims), (5006, [math.inf] * dims), (5007, rows[3][1] + [0.5])]
    frame = spark.createDataFrame([(*row, 1, "x", 0) for row in rows], f"vec_id long, embedding array<{kind}>, label int, kept string, n_links int")
    found = sorted((tuple(row) for row in near_vectors(frame.repartition(3), options=options).collect()), key=repr)
    assert len(found) == len(rows)
    expected = _expected(rows)
    # a row without an id links with nothing and is kept
    assert [row for row in found if row[0] is not None] == [row for row in expected if row[0] is not None]
    assert [row for row in found if row[0] is None] == [(None, 0, None, True)]


def test_only_vectors_that_cannot_link_and_no_rows(spark):
    frame = spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, near_vectors(frame).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert near_vectors(frame.limit(0)).collect() == []
