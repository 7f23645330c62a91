"""Periodic runs against all starts and periods by brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from stagemart.llm.runs import _runs, _told, find_runs
from stagemart.llm.words import blocks, mix


def _brute(words):
    """(start, length, period) of every run, by comparing at every lag."""
    found = {}
    for lag in range(1, len(words) // 4 + 1):
        start = None
        for at in range(len(words) - lag + 1):
            same = at + lag < len(words) and words[at] == words[at + lag]
            if same and start is None:
                start = at
            if not same and start is not None:
                if at - start + lag >= max(6, 4 * lag):
                    found.setdefault((start, at - start + lag), lag)  # the least lag comes first
                start = None
    return sorted((start, length, lag) for (start, length), lag in found.items())


def _collapsed(words, runs):
    gone = {at for start, length, period in runs for at in range(start + period, start + length)}
    return " ".join(word for at, word in enumerate(words) if at not in gone)


def _expected(text):
    words = [word for word in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if word]
    runs = _brute(words)
    return len(words), runs, _collapsed(words, runs)


def _fibonacci(size):
    a, b = "a", "ab"
    while len(b) < size:
        a, b = b, b + a
    return list(b[:size])


def _periodic(rng, size, period, letters):
    cycle = [rng.choice(letters) for _ in range(period)]
    return [cycle[at % period] for at in range(size)]


def _word_lists():
    rng = random.Random(11)
    lists = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 700, ["a", "b"] * 3, ["a", "b"] * 4, _fibonacci(600)]
    lists.append([str(bin(at).count("1") % 2) for at in range(512)])
    for letters in ("ab", "abc", "abcdefgh"):
        for _ in range(25):
            lists.append([rng.choice(letters) for _ in range(rng.randrange(120))])
            parts = [_periodic(rng, rng.randrange(5, 300), rng.randrange(1, 60), letters) for _ in range(3)]
            lists.append([word for part in parts for word in part])
    for period in range(1, 70):  # just long enough, and one word short of it
        cycle = [f"w{at}" for at in range(period)]
        lists += [["x"] + cycle * 4 + ["y"], ["x"] + (cycle * 4)[:-1] + ["y"]]
    inner = (["u", "v", "w"] * 5 + ["z"]) * 6
    return lists + [inner, inner * 4 + ["q"] + inner * 5]


def test_all_runs_are_found_and_no_others():
    lists = _word_lists()
    texts = [" ".join(words) for words in lists]
    (block,) = blocks(pa.array(texts).cast(pa.binary()))
    told = _told(block).to_pylist()
    for words, row in zip(lists, told):
        runs = _brute(words)
        assert [tuple(run.values()) for run in row["runs"]] == runs
        assert (row["n_words"], row["collapsed"]) == (len(words), _collapsed(words, runs))
    assert sum(len(row["runs"]) for row in told) > 300


@pytest.mark.parametrize("period", [1, 7, 8, 9, 16, 17, 1000, 20_000])
def test_long_runs_take_few_steps(period):
    tokens = mix(np.arange(400_000, dtype=np.uint64) % np.uint64(period))
    tokens = np.append(tokens, mix(np.array([1 << 50], np.uint64)))
    assert [part.tolist() for part in _runs(tokens, np.array([400_000]))] == [[0], [400_000], [period]]


ODD = [
    None, "", " \t\n ", "one", "a a a a a a", "A a A a a a", "na\tna\nna\x0bna\x0cna\rna end", "a a a a a a", "é ü é ü é ü é ü É", "x" * 70_000 + " y" * 9,
    "the end " * 30_000, " lead  and   trail ", "a b c a b c a b c a b c", "a b c a b c a b c a b",
]


def test_odd_texts(spark):
    rows = [(number, text, "x", 7) for number, text in enumerate(ODD * 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed int").repartition(3)
    found = find_runs(frame)
    assert found.columns == [*frame.columns, "periodic"]
    for row in found.collect():
        told = row.periodic.n_words, [tuple(run) for run in row.periodic.runs], row.periodic.collapsed
        assert (row.runs, row.collapsed) == ("x", 7)
        assert told == (_expected(row.text) if len(row.text or "") < 100_000 else (60_000, [(0, 60_000, 2)], "the end"))
    assert find_runs(frame.limit(0)).collect() == []
    with pytest.raises(ValueError, match="collapsed"):
        find_runs(frame, output="collapsed")
