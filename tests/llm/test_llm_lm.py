"""Language-model scores: exact base counts, a normalised model, and what it gains on texts it did not learn from."""

import collections
import math
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stagemart.llm import lm
from stagemart.llm.lm import LogBilinear, Lookup, ModelOptions, Tokens, Trainer, Tree, score_texts
from stagemart.llm.queries import op2_lm_scoring
from stagemart.llm.words import blocks


def _tokens(text):
    return (text or "").encode().lower().split() + [None]


def _expected(rows):
    counts = collections.Counter(token for _, text, learned in rows if learned for token in _tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    found = collections.defaultdict(list)
    for ident, text, learned in rows:
        own = _tokens(text)
        base = sum(math.log10((counts[token] + 1) / (total + distinct + 1)) for token in own)
        found[ident].append((learned, len(own), sum(counts[token] > 0 for token in own), total, base))
    return found


def _assert_equal(rows, found):
    expected = _expected(rows)
    assert len(found) == len(rows)
    for row in found:
        assert any(
            (row.learned, row.n_tokens, row.n_known, row.train_tokens) == one[:4] and row.base_score == pytest.approx(one[4], rel=1e-9, abs=1e-9)
            for one in expected[row.id]
        ), row
        assert row.score <= 1e-6


@pytest.mark.parametrize("common", [1 << 18, 40, 0], ids=["all sent", "most joined", "all joined"])
def test_base_equals_plain_counts(spark, common):
    rows = [(row.doc_id, row.text, row.doc_id % 3 > 0) for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(-1, None, True), (-2, "", False), (-3, "new WORDS only", False), (-4, "again " * 200_000, True), (-4, "again " * 200_000, True), (None, "x", True)]
    frame = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id long, text string, learn boolean, n int, word string")
    _assert_equal(rows, score_texts(frame, F.col("learn"), options=ModelOptions(common=common, width=9)).collect())


def test_scores_beat_the_base_on_texts_not_learned_from(spark):
    rows = op2_lm_scoring(spark, "/root/testdata/sf0.01").collect()
    held = [row for row in rows if row.held_out]
    assert {row.doc_id for row in held} == {row.doc_id for row in rows if zlib.crc32(str(row.doc_id).encode()) % 7 == 2}
    assert sum(row.score for row in held) > 0.99 * sum(row.base_score for row in held)


COUNTS = [[5], [3, 1], [7] * 1000, [*range(1, 900)], [2**n for n in range(40)]]


def _model(counts, width, dims=5, seed=2, spread=1.0):
    tree = Tree(np.array(counts), width)
    rows = np.random.default_rng(seed).normal(0, spread, (len(counts) + 3 + len(tree.share), dims + 1))
    return LogBilinear(tree, dims, rows)


@pytest.mark.parametrize("width", [2, 7, 256])
@pytest.mark.parametrize("counts", COUNTS, ids=["one", "two", "equal", "rising", "steep"])
def test_a_tree_starts_as_shares_and_stays_normalised(counts, width):
    tree = Tree(np.array(counts), width)
    assert np.diff(tree.first).max() <= width and (np.sort(np.concatenate([tree.item, tree.own[:-1]])) == np.arange(len(tree.share))).all()
    model, words = LogBilinear(tree, 5, LogBilinear.initial(tree, 5)), np.arange(len(counts))
    model.items[:, :-1] = 0
    none = np.zeros(len(counts), np.int64)
    assert 10 ** model.score(none, none, words) == pytest.approx(np.array(counts) / sum(counts), rel=1e-3)
    model = _model(counts, width)
    for one, two in ((0, 0), (len(counts), 0), (len(counts) - 1, len(counts))):
        assert sum(10 ** model.score(none + one, none + two, words)) == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("spread", [0.5, 20.0])
def test_scores_equal_plain_choices(spread):
    """The whole probability of each word of a small text, choice by choice."""
    model = _model([5, 4, 3, 3, 2, 2, 1, 1, 1], 3, spread=spread)
    tree, text = model.tree, [0, 3, 3, 8, 1, 7]
    found = model.score(np.array([9, *text[:-1]]), np.array([9, 9, *text[:-2]]), np.array(text))
    for place, word in enumerate(text):
        one, two = (text[place - 1] if place else 9), (text[place - 2] if place > 1 else 9)
        predicted = [float(a) * float(r) + float(b) * float(q) for a, b, r, q in zip(model.context[one], model.context[two], *model.weights)]
        total, item = 0.0, tree.item[word]
        while item >= 0:
            node = tree.above[item]
            plain = [sum(p * float(q) for p, q in zip(predicted, model.items[other])) + float(model.items[other][-1]) for other in range(tree.first[node], tree.first[node + 1])]
            most = max(plain)
            total += plain[item - tree.first[node]] - most - math.log(sum(math.exp(value - most) for value in plain))
            item = tree.own[node]
        assert found[place] == pytest.approx(total / math.log(10), rel=1e-4, abs=1e-4)


def test_the_whole_distribution_over_texts_of_one_word(spark):
    """The shares of all one-word texts over known words, and one for unseen ones, come to one with the end."""
    known = ["a", "b", "c", "d"]
    training = [(0, "a b a c a", True), (1, "b d a", True), (2, "c", True)]
    probes = [(10 + n, word, False) for n, word in enumerate([*known, "unseen"])]
    frame = spark.createDataFrame(training + probes, "doc_id long, text string, learn boolean")
    found = {row.id: row.score for row in score_texts(frame, F.col("learn"), options=ModelOptions(width=2)).collect()}
    assert 0 < sum(10 ** found[ident] for ident, _, _ in probes) < 1


def test_a_node_is_trained_by_the_gradient_of_its_objective():
    random = np.random.default_rng(3)
    model = _model([3, 4, 5, 6, 7, 8], 6, dims=4)
    options = ModelOptions(dims=4, noise=6)
    chosen, predicted = random.integers(0, 6, 30), np.column_stack([random.normal(0, 1, (30, 4)), np.ones(30)]).astype(np.float32)
    trainer = Trainer(model, options, 0)
    low, high = model.tree.first[0], model.tree.first[1]
    # the samples the trainer is about to draw
    reach = trainer.reach[low:high]
    drawn = np.searchsorted(reach, np.random.default_rng(0).random(6))

    def loss(predicted, items):
        told = (predicted * items[chosen]).sum(axis=1) - trainer.log_noise[low:high][chosen]
        other = predicted @ items[drawn].T - trainer.log_noise[low:high][drawn]
        return np.logaddexp(0, -told).sum() + np.logaddexp(0, other).sum()

    items, step = model.items[low:high].astype(np.float64), 1e-4
    by_item = np.zeros(items.shape)
    for at in np.ndindex(*items.shape):
        moved = np.zeros(items.shape)
        moved[at] = step
        by_item[at] = (loss(predicted, items + moved) - loss(predicted, items - moved)) / (2 * step)
    by_predicted = np.zeros((30, 4))
    for at in np.ndindex(30, 4):
        moved = np.zeros((30, 5))
        moved[at] = step
        by_predicted[at] = (loss(predicted + moved, items) - loss(predicted - moved, items)) / (2 * step)
    before = trainer.seen_items[low:high].copy()
    assert trainer.choices(0, predicted, chosen) == pytest.approx(by_predicted, abs=1e-3)
    assert model.items[low:high] == pytest.approx(items - options.rate * by_item / np.sqrt(before + by_item**2), abs=1e-4)
    assert trainer.item_steps.sum() == 36


def test_words_in_lower_nodes_depend_on_their_context(spark):
    """Each left word is followed by its right one, and both lie below the root."""
    training = [(n, f"the left{n % 30} right{n % 30}", True) for n in range(6000)]
    probes = [(10_000 + 100 * kind + n, f"the left{n} right{(n + kind) % 30}", False) for kind in (0, 1) for n in range(30)]
    frame = spark.createDataFrame(training + probes, "doc_id long, text string, learn boolean").coalesce(1)
    options = ModelOptions(width=8, block=256, batch=64, small_batch=64, rate=0.5)
    found = {row.id: row for row in score_texts(frame, F.col("learn"), options=options).collect()}
    told, mixed = (sum(found[10_000 + 100 * kind + n].score for n in range(30)) for kind in (0, 1))
    assert sum(found[10_000 + n].base_score for n in range(30)) == pytest.approx(sum(found[10_100 + n].base_score for n in range(30)))
    assert told > mixed + 10


@pytest.mark.parametrize("width", [2, 7, 256])
@pytest.mark.parametrize("counts", COUNTS, ids=["one", "two", "equal", "rising", "steep"])
def test_words_of_a_node_lie_side_by_side(counts, width):
    tree = Tree(np.array(counts), width)
    assert (np.sort(tree.place) == np.arange(len(counts))).all()
    below = [[] for _ in tree.share]  # the places of the words of each item, by climbing
    for word in range(len(counts)):
        item = tree.item[word]
        while item >= 0:
            below[item].append(tree.place[word])
            item = tree.own[tree.above[item]]
    for node in range(tree.nodes):
        cuts = tree.cuts(node, np.arange(len(counts) + 1))
        items = tree.by_place[tree.first[node] : tree.first[node + 1]]
        assert sorted(items) == list(range(tree.first[node], tree.first[node + 1]))
        assert [sorted(below[item]) for item in items] == [list(range(low, high)) for low, high in zip(cuts[:-1], cuts[1:])]
        assert (np.diff(np.isin(items, tree.own).astype(int)) >= 0).all()  # nodes after words


@pytest.mark.parametrize("held", [0, 1, 2, 1000])
def test_lookup_equals_search(held):
    random = np.random.default_rng(held)
    largest = (1 << 64) - 1
    hashes = np.unique(np.append(random.integers(0, largest, held, np.uint64, endpoint=True), np.array([0, largest] if held > 1 else [], np.uint64)))
    asked = np.concatenate([hashes, hashes + np.uint64(1), hashes - np.uint64(1), random.integers(0, largest, 500, np.uint64), np.array([0, 5, largest], np.uint64)])
    place = {value: at for at, value in enumerate(hashes.tolist())}
    assert Lookup(hashes)(asked).tolist() == [place.get(value, len(hashes)) for value in asked.tolist()]


def test_tokens_do_not_depend_on_the_pieces(monkeypatch):
    texts = ["", "One two  three", None, "x" * 50, " a\tb\n", "two " * 30, "last"]
    (block,) = blocks(pa.array(texts).cast(pa.binary()))
    whole = Tokens(block)
    assert np.diff(whole.offsets).tolist() == [len(_tokens(text)) for text in texts]
    for size in (1, 20, 60):
        monkeypatch.setattr(lm, "_PIECE_BYTES", size)
        cut = Tokens(block)
        assert (cut.offsets == whole.offsets).all() and (cut.hashes == whole.hashes).all()


def test_contexts_move_by_the_sums_of_their_gradients(monkeypatch):
    monkeypatch.setattr(lm, "_PIECE_ROWS", 16)
    random = np.random.default_rng(4)
    trainer = Trainer(_model([3] * 30, 6), ModelOptions(dims=5), 0)
    one, two = random.integers(0, 31, 200), np.where(random.random(200) < 0.4, 30, random.integers(0, 31, 200))
    given, model = random.normal(0, 1, (200, 5)).astype(np.float32), trainer.model
    before, sums, times = model.context.copy(), np.zeros(model.context.shape), np.zeros(len(model.context), int)
    for side, ids in enumerate((one, two)):
        for row, ident in enumerate(ids):
            sums[ident] += given[row] * model.weights[side]
            times[ident] += 1
    trainer._step_contexts(one, two, given, trainer.seen_context)
    assert trainer.seen_context == pytest.approx(1 + sums**2, rel=1e-3, abs=1e-3)
    assert model.context == pytest.approx(before - trainer.options.rate * sums / np.sqrt(1 + sums**2), abs=1e-4)
    assert (trainer.context_steps == times).all()


def test_a_step_of_many_contexts_takes_little_memory():
    """The contexts of a whole block are moved in pieces: 26 MB of gradients are never held sorted and summed beside themselves."""
    random = np.random.default_rng(5)
    trainer, given = Trainer(_model([3] * 50_000, 128, dims=16), ModelOptions(), 0), np.ones((200_000, 16), np.float32)
    one, two = random.integers(0, 50_000, (2, 200_000))
    tracemalloc.start()
    trainer._step_contexts(one, two, given, trainer.seen_below)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6


def test_scores_are_equal_with_and_without_taking_off_the_greatest(monkeypatch):
    random = np.random.default_rng(6)
    model = _model([*range(1, 400)], 16, spread=0.7)
    one, two, words = random.integers(0, 400, (3, 3000))
    words = np.minimum(words, 398)
    plain = model.score(one, two, words)
    monkeypatch.setattr(lm, "_SAFE", 0.0)
    assert model.score(one, two, words, 100) == pytest.approx(plain, abs=1e-4)


def test_nothing_to_learn_from_and_no_rows(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = {row.id: row for row in score_texts(frame, F.lit(False)).collect()}
    assert (found[1].n_tokens, found[1].n_known, found[1].train_tokens, found[1].base_score) == (3, 0, 0, 0.0)
    assert found[1].score == pytest.approx(0, abs=1e-6) and found[2].n_tokens == 1
    assert score_texts(frame.limit(0), F.lit(True)).collect() == []
