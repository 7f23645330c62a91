"""Packing against a plain best fit that looks at every bin."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stagemart.llm.packing import PackingOptions, best_fit, pack, pack_texts


def _plain(lengths, sources, clusters, capacity, per_source):
    bins, found, places = [], [], []
    for length, source, cluster in zip(lengths, sources, clusters):
        fitting = [
            (capacity - sum(held[0] for held in own), number)
            for number, own in enumerate(bins)
            if capacity - sum(held[0] for held in own) >= length
            and sum(held[1] == source for held in own) < per_source
            and not any(held[2] == cluster >= 0 for held in own)
        ]
        number = min(fitting)[1] if fitting else len(bins)
        if not fitting:
            bins.append([])
        places.append(sum(held[0] for held in bins[number]))
        bins[number].append((length, source, cluster))
        found.append(number)
    return found, places


@pytest.mark.parametrize("seed", range(30))
def test_best_fit_equals_looking_at_every_bin(seed):
    random_ = random.Random(seed)
    count = random_.randrange(1, 120)
    lengths = [random_.randrange(1, 51) for _ in range(count)]
    sources = [min(random_.randrange(6), random_.randrange(6)) for _ in range(count)]
    clusters = [random_.choice([-1, -1, 0, 1, 2, 70, 200]) for _ in range(count)]
    if seed % 2:
        lengths.sort(reverse=True)
    per_source = random_.choice([1, 2, 4])
    assert best_fit(lengths, sources, clusters, 50, per_source) == _plain(lengths, sources, clusters, 50, per_source)


def _check(rows, found, options):
    """Every row once and whole; no bin over capacity, over its sources or with two of a cluster; places follow on."""
    pieces, bins = defaultdict(list), defaultdict(list)
    for row in found:
        pieces[row.id].append((row.piece, row.length))
        if row.bin is not None:
            bins[row.bin].append((row.place, row.length, row.id))
    facts = defaultdict(list)
    for ident, length, source, cluster in rows:
        facts[ident].append((length or 0, source, cluster))
    for ident, own in facts.items():
        expected = []
        for length, _, _ in own:
            cut = [min(options.capacity, length - at) for at in range(0, length, options.capacity)] or [0]
            expected += list(enumerate(cut))
        assert sorted(pieces.pop(ident)) == sorted(expected)
    assert not pieces
    for own in bins.values():
        at = 0
        for place, length, _ in sorted(own):
            assert place == at and length > 0
            at += length
        assert at <= options.capacity
        single = [facts[ident][0] for _, _, ident in own if len(facts[ident]) == 1]
        for source in {source for _, source, _ in single}:
            assert sum(each[1] == source for each in single) <= options.per_source
        clusters = [each[2] for each in single if each[2] is not None]
        assert len(clusters) == len(set(clusters))


@pytest.mark.parametrize("options", [PackingOptions(100, 2, 64), PackingOptions(100, 1, 10_000), PackingOptions(7, 3, 1)])
def test_every_row_is_packed_within_the_limits(spark, options):
    random_ = random.Random(1)
    rows = [(n, random_.choice([None, 0, 1, 5, 20, 60, 100, 101, 350]), random_.choice(["hot", "hot", "a", "b", None]), random_.choice([None, 1, 1, 2, n + 10])) for n in range(400)]
    rows += [(900, 30, "a", 7)] * 40
    frame = spark.createDataFrame([(*row, 1, "x") for row in rows], "id long, size long, source string, copies long, bin int, piece string").repartition(3)
    found = pack(frame, F.col("id"), F.col("size"), F.col("source"), F.col("copies"), options).collect()
    _check(rows, found, options)


def test_texts_are_packed_tightly(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    options = PackingOptions()
    found = pack_texts(documents, options=options).collect()
    rows = [(row.doc_id, len((row.text or "").encode().split()) + 1, row.source, hash(row.text)) for row in documents.collect()]
    _check(rows, found, options)
    bins = len({row.bin for row in found})
    assert sum(row.length for row in found) / (bins * options.capacity) > 0.95


def test_odd_texts_and_no_rows(spark):
    texts = [(1, None, "a"), (2, "", None), (3, " \n", "a"), (4, "w " * 10_000, "a"), (5, "w", None), (5, "w", None), (None, "x y", "b")]
    frame = spark.createDataFrame(texts, "doc_id long, text string, source string")
    found = pack_texts(frame).collect()
    assert sorted((row.id, row.length) for row in found if row.bin is None) == [(1, 0), (2, 0), (3, 0)]
    assert sorted(row.length for row in found if row.id == 4) == [10_001 - 2 * 4096, 4096, 4096]
    assert sorted(row.length for row in found if row.id is None) == [3] and sum(row.id == 5 for row in found) == 2
    assert pack_texts(frame.limit(0)).collect() == []
