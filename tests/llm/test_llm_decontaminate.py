"""Verbatim benchmark passages against every window by brute force."""

import hashlib
import random
import re

import pytest

from stagemart.llm.decontaminate import find_contamination

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return _WORD.findall((text or "").encode().lower())


def _expected(text, items, size=13):
    own, hit, found = _words(text), set(), set()
    for item, said in items:
        words = _words(said)
        length = min(size, len(words))
        windows = {tuple(words[at : at + length]) for at in range(len(words) - length + 1)} if length else set()
        for at in range(len(own) - length + 1 if length else 0):
            if tuple(own[at : at + length]) in windows:
                hit.update(range(at, at + length))
                found.add("null" if item is None else str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(own), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(own)


def _longest(text, said):
    """The longest common run of words, by dynamic programming."""
    own, words, best = _words(text), _words(said), 0
    row = [0] * (len(words) + 1)
    for word in own:
        row = [0] + [row[at] + 1 if word == other else 0 for at, other in enumerate(words)]
        best = max(best, *row)
    return best


def _made():
    random.seed(11)
    letters = [f"w{n}" for n in range(12)]
    items = [(n, " ".join(random.choices(letters, k=random.choice([1, 3, 13, 14, 30, 60])))) for n in range(25)]
    items += [(25, None), (26, ""), (27, "?!"), (28, items[3][1]), (None, items[5][1]), (30, "so so so so so so so so so so so so so so so so")]
    texts = [None, "", "...", "W3", "so " * 40, "so " * 12, "so." * 5000]
    for _ in range(60):
        parts = []
        for _ in range(random.randrange(1, 6)):
            said = (random.choice(items)[1] or "zz").split() or ["zz"]
            start = random.randrange(len(said))
            parts += said[start : start + random.randrange(1, 40)] + random.choices(letters + ["zz", "Été", "w1"], k=random.randrange(0, 8))
        texts.append(random.choice([" ", ", ", "\n"]).join(parts).upper().replace("ÉTÉ", "été"))
    return texts + texts[-2:], items


@pytest.mark.parametrize("block_words", [10**6, 40], ids=["one block", "many blocks"])
def test_hits_equal_all_windows(spark, block_words):
    texts, items = _made()
    documents = spark.createDataFrame([(n, text, 0, "x") for n, text in enumerate(texts)], "doc_id long, text string, n_hit int, item string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(documents, benchmark, block_words=block_words).collect()
    assert len(found) == len(texts)
    for row in found:
        said = row.contamination
        assert (said.n_words, said.n_hit, said.n_items, said.items_sha256, said.contaminated) == _expected(texts[row.doc_id], items), texts[row.doc_id]
        longest = 0
        for match in said.matches:
            words = _words(dict((str(a), b) for a, b in items if a is not None).get(match.item, items[5][1]))
            stretch = _words(texts[row.doc_id])[match.start : match.start + match.length]
            assert stretch == words[match.item_start : match.item_start + match.length]
            longest = max(longest, match.length)
        if said.n_hit and block_words > 40:  # a match that holds a window may run on in any item
            common = {item: _longest(texts[row.doc_id], one) for item, one in items}
            held = [item for item, one in items if _expected(texts[row.doc_id], [(item, one)])[1]]
            assert max(common[item] for item in held) <= longest <= max(common.values())
        assert (row.n_hit, row.item) == (0, "x")


@pytest.mark.parametrize("count", [400])
def test_a_passage_that_all_share_is_told_once(spark, count):
    passage = " ".join(f"p{number}" for number in range(17))
    documents = spark.createDataFrame([(n, f"own{n} {passage} end{n}") for n in range(count)], "doc_id long, text string").coalesce(1)
    benchmark = spark.createDataFrame([(n, f"{passage} q{n}") for n in range(count)], "item_id long, text string").coalesce(1)
    digest = hashlib.sha256(",".join(sorted(map(str, range(count)))).encode()).hexdigest()
    for row in find_contamination(documents, benchmark).collect():
        said = row.contamination
        assert (said.n_words, said.n_hit, said.n_items, said.items_sha256) == (19, 17, count, digest)
        assert [(match.start, match.length) for match in said.matches] == [(1, 17)]


def test_a_text_of_one_word(spark):
    documents = spark.createDataFrame([(1, "so " * 300_000), (2, "so " * 12)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(n, "so " * 100) for n in range(3)] + [(9, "so so x")], "item_id long, text string")
    found = {row.doc_id: row.contamination for row in find_contamination(documents, benchmark).collect()}
    assert (found[1].n_words, found[1].n_hit, found[1].n_items, len(found[1].matches), found[1].matches[0].length) == (300_000, 300_000, 3, 1, 100)
    assert (found[2].n_hit, found[2].matches) == (0, [])


def test_a_column_of_the_output_name_raises(spark):
    frame = spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, contamination int")
    with pytest.raises(ValueError, match="contamination"):
        find_contamination(frame, frame.select(frame.doc_id.alias("item_id"), "text"))


def test_empty_tables(spark):
    documents = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    found = {row.doc_id: row.contamination for row in find_contamination(documents, none).collect()}
    assert (found[1].n_words, found[1].n_hit, found[1].contaminated, found[2].n_words) == (2, 0, False, 0)
    assert find_contamination(documents.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []
