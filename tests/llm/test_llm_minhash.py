"""Near-duplicate texts against all pairs by brute force."""

import random

import pytest
from conftest import SMALLEST

from stagemart.llm.components import connected_components, forest_roots
from stagemart.llm.minhash import MinHashOptions, near_duplicates
from stagemart.llm.scratch import Scratch


def _set(text, size):
    cut = (text or "").encode().lower().split()
    return {tuple(cut)} - {()} if len(cut) <= size else set(zip(*(cut[step:] for step in range(size))))


def _expected(rows, size):
    """All pairs; rows of one id are one node."""
    sets = [_set(text, size) for _, text in rows]
    parent = {ident: ident for ident, _ in rows if ident is not None}

    def top(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a in range(len(rows)):
        for b in range(a):
            if None in (rows[a][0], rows[b][0]) or not sets[a] or not sets[b]:
                continue
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                one, other = top(rows[a][0]), top(rows[b][0])
                parent[max(one, other)] = min(one, other)
    found = []
    for (ident, _), own in zip(rows, sets):
        component = None if ident is None else top(ident)
        found.append((ident, len(own), component, component == ident))
    return sorted(found, key=repr)


def _families():
    random.seed(3)
    rows, number = [], 0
    for size in (6, 12, 40, 40, 120, 400):
        base = [f"w{random.randrange(5000)}" for _ in range(size)]
        for _ in range(25):
            copy = list(base)
            for _ in range(random.randrange(0, max(2, size // 12))):
                copy[random.randrange(size)] = f"x{random.randrange(5000)}"
            rows.append((number, "  ".join(copy)))
            number += random.randrange(1, 4)
    random.shuffle(rows)
    return rows


EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "one"), (6, "ONE two"), (7, "one\ntwo"), (7, "one\ntwo"), (8, "two one"),
    (None, "one two"), (None, None), (9, "long " * 60_000 + "end"), (10, "long " * 60_000 + "end"), (11, "a b c d e f g h"), (11, "q r s t u v w x"), (12, "q r s t u v w x"),
]


@pytest.mark.parametrize("options", [MinHashOptions(shingle=4), MinHashOptions(), MinHashOptions(tile_rows=3), MinHashOptions(filter_bits=1 << 9)], ids=["four", "five", "tiles", "filter shards"])
def test_families_and_edges_equal_all_pairs(spark, options):
    rows = _families() + [(None if ident is None else ident + 100_000, text) for ident, text in EDGES]
    frame = spark.createDataFrame([(a, b, 1, "x", 2) for a, b in rows], "doc_id long, text string, kept int, n string, component int")
    found = sorted((tuple(row) for row in near_duplicates(frame.repartition(4), options=options).collect()), key=repr)
    assert found == _expected(rows, options.shingle)


def test_smallest_tables_equal_all_pairs(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id", "text").collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(row) for row in near_duplicates(frame).collect()), key=repr) == _expected(rows, 5)


def test_no_rows(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, 200 + n) for n in range(30)] + [(300 + n, 300 + (n + 7) % 15) for n in range(15)] + [(400, 400)]
    random.Random(5).shuffle(edges)
    frame = spark.createDataFrame([edge if n % 2 else edge[::-1] for n, edge in enumerate(edges)], "a long, b long")
    found = {row.node: row.component for row in connected_components(frame, Scratch(spark, "test")).collect()}
    assert found == {n: 0 for n in range(41)} | {100: 100} | {200 + n: 100 for n in range(30)} | {300 + n: 300 for n in range(15)}


def test_roots_of_a_deep_tree_and_a_hub(spark):
    parents = [(n, n - 1) for n in range(1, 70)] + [(100 + n, 99) for n in range(50)] + [(200, 120)]
    random.Random(2).shuffle(parents)
    frame = spark.createDataFrame(parents + parents[:3], "a long, b long")
    found = {row.node: row.component for row in forest_roots(frame, Scratch(spark, "test")).collect()}
    assert found == {n: 0 for n in range(70)} | {n: 99 for n in range(99, 150)} | {200: 99}
    assert forest_roots(frame.limit(0), Scratch(spark, "test")).collect() == []
