"""Words and shingles by numpy against plain Python."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from stagemart.llm.words import ALPHANUMERIC, NOT_BLANK, blocks, shingles, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ \t\n\r\x0b\x0c\x85\xa0é中09.-_", max_size=40)), max_size=12)


def _plain(text, kind):
    data = (text or "").encode()
    spaced = bytes(byte if kind[byte] else 32 for byte in data)
    return spaced.lower().split(b" ") if kind is ALPHANUMERIC else data.lower().split()


@settings(max_examples=80, deadline=None)
@given(texts=TEXTS, size=st.integers(1, 50))
def test_words_do_not_depend_on_blocks_and_match_plain_cutting(texts, size):
    column = pa.array(texts, pa.string())
    for kind in (NOT_BLANK, ALPHANUMERIC):
        of_hash = {}
        for block in blocks(column, size):
            found = words(block, kind)
            for row in range(block.rows):
                own = slice(found.offsets[row], found.offsets[row + 1])
                cut = [bytes(block.data[a:b]).lower() for a, b in zip(found.starts[own], found.ends[own])]
                assert cut == [word for word in _plain(texts[block.first + row], kind) if word]
                for word, value in zip(cut, found.hashes[own].tolist()):
                    assert of_hash.setdefault(word, value) == value
        assert len(set(of_hash.values())) == len(of_hash)


@settings(max_examples=60, deadline=None)
@given(texts=TEXTS, size=st.integers(1, 6))
def test_equal_shingles_have_equal_hashes(texts, size):
    names = {}
    for block in blocks(pa.array(texts, pa.string()), 30):
        found = words(block)
        hashes, offsets = shingles(found, size)
        for row in range(block.rows):
            cut = _plain(texts[block.first + row], NOT_BLANK)
            runs = [tuple(cut)] if 0 < len(cut) <= size else [tuple(cut[at : at + size]) for at in range(len(cut) - size + 1)]
            own = hashes[offsets[row] : offsets[row + 1]].tolist()
            assert len(own) == len(runs)
            for run, value in zip(runs, own):
                assert names.setdefault(run, value) == value
    assert len(set(names.values())) == len(names)


def test_a_slice_of_a_column_and_no_column_at_all():
    column = pa.array(["a b", "c", None, "d e f"])
    assert [block.rows for block in blocks(column.slice(1, 3), 2)] == [2, 1]
    assert [len(words(block).hashes) for block in blocks(column.slice(1, 3))] == [4]
    assert list(blocks(column.slice(0, 0))) == []
