"""Periodic runs of words, found by minimizers on several scales and by direct comparison at short periods."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagemart.llm.shipping import session_of
from stagemart.llm.words import Block, blocks, mix, words

#: A run repeats its period four times at least, and is six words long at least.
TIMES, LEAST = 4, 6
#: Periods up to here are compared directly; the first scale takes those up to twice as long.
_DIRECT = 8
_COMPARED = 64
_AS_WRITTEN = np.arange(256, dtype=np.uint8)
_FACTOR = np.uint64(0xD1342543DE82EF95)


def _stretches(told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where maximal stretches of true values start and end."""
    change = np.diff(np.concatenate([[False], told, [False]]).astype(np.int8))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def _slid(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least (or the greatest) of each ``width`` values in a row, a power of two."""
    step, choose = 1, np.minimum if least else np.maximum
    while step < width:
        values = choose(values[:-step], values[step:])
        step *= 2
    return values


def _longer(grams: np.ndarray, size: int) -> np.ndarray:
    """Hashes of twice as many words in a row; what runs over the end is unlike all else."""
    beyond = mix(np.arange(len(grams), len(grams) + size, dtype=np.uint64) ^ np.uint64(size << 40))
    following = np.concatenate([grams, beyond])[size : size + len(grams)]
    return mix(grams * _FACTOR + (following ^ (following >> np.uint64(29))))


def _selected(grams: np.ndarray, width: int) -> np.ndarray:
    """Places whose value is the least of some window of ``width``."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    edge = np.zeros(width - 1, np.uint64)
    greatest = _slid(np.concatenate([edge, _slid(grams, width, True), edge]), width, False)
    return np.flatnonzero(greatest == grams)


def _agreeing(tokens: np.ndarray, at: np.ndarray, lag: np.ndarray, step: int) -> np.ndarray:
    """How many tokens in a row, from ``at`` on in direction ``step``, equal those ``lag`` further on."""
    found, active = np.zeros(len(at), np.int64), np.arange(len(at))
    reach = step * np.arange(_COMPARED)
    while len(active):
        place = (at[active] + step * found[active])[:, None] + reach
        other = place + lag[active, None]
        inside = (place >= 0) & (other < len(tokens))
        same = inside & (tokens[np.where(inside, place, 0)] == tokens[np.where(inside, other, 0)])
        whole = same.all(axis=1)
        found[active] += np.where(whole, _COMPARED, np.argmin(same, axis=1))
        active = active[whole]
    return found


def _at_scale(tokens: np.ndarray, grams: np.ndarray, size: int) -> list[np.ndarray]:
    """(starts, lengths, periods) of runs with periods over size / 2 and up to size; ``grams`` hash ``size`` tokens in a row.

    In a run of such a period, grams are equal at multiples of the period and nowhere else, and a
    window of size / 2 of them has its least where the window one period on has its own. So some two
    selected places next to each other among those of equal value lie one period apart, and seed the run.
    """
    chosen = _selected(grams, size // 2)
    order = np.argsort(grams[chosen], kind="stable")
    chosen, value = chosen[order], grams[chosen][order]
    lag = chosen[1:] - chosen[:-1]
    seeds = np.flatnonzero((value[1:] == value[:-1]) & (lag > size // 2) & (lag <= size))
    at, lag = chosen[seeds], lag[seeds]
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    # seeds of one lag whose grams touch belong together: only the ends of what they cover are extended
    opens = np.flatnonzero(np.concatenate([[True], (lag[1:] != lag[:-1]) | (at[1:] > at[:-1] + size)])) if len(at) else at
    low, high, lag = at[opens], at[np.append(opens[1:], len(at)) - 1] + size if len(at) else at, lag[opens]
    start = low - _agreeing(tokens, low - 1, lag, -1)
    length = high + _agreeing(tokens, high, lag, 1) - start + lag
    kept = length >= np.maximum(LEAST, TIMES * lag)
    return [start[kept], length[kept], lag[kept]]


def _runs(tokens: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """(starts, lengths, periods) of all runs, in order; ``tokens`` are texts of ``sizes`` words, each with a token of its own kind after it."""
    found = []
    for lag in range(1, _DIRECT + 1):
        start, end = _stretches(tokens[:-lag] == tokens[lag:])
        kept = end - start + lag >= max(LEAST, TIMES * lag)
        found.append([start[kept], end[kept] - start[kept] + lag, np.full(np.count_nonzero(kept), lag)])
    grams, size = tokens, 1
    place = np.arange(len(tokens))
    while True:
        grams = _longer(grams, size)
        size *= 2
        if size <= _DIRECT:
            continue
        long = sizes >= TIMES * (size // 2 + 1)  # others cannot hold a run on this scale, nor on the next
        if not long.any():
            break
        held = np.repeat(long, sizes + 1)
        tokens, grams, place, sizes = tokens[held], grams[held], place[held], sizes[long]
        start, length, lag = _at_scale(tokens, grams, size)
        found.append([place[start], length, lag])
    start, length, period = (np.concatenate(part) for part in zip(*found))
    # a run is also found at multiples of its period, with the same ends: the least counts
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])]) if len(start) else np.zeros(0, bool)
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return [start[order], length[order], period[order]]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, count: np.ndarray) -> pa.Array:
    """Texts of ``count`` words each, joined by one blank."""
    length = ends - starts + 1  # with the blank after it
    row_ends = np.cumsum(count)
    last = row_ends[count > 0] - 1
    length[last] -= 1
    offset = np.concatenate([[0], np.cumsum(length)])
    out = np.full(offset[-1], 0x20, np.uint8)
    size = ends - starts
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(offset[:-1], size) + inner] = data[np.repeat(starts, size) + inner]
    text_offsets = offset[np.concatenate([[0], row_ends])]
    return pa.LargeStringArray.from_buffers(len(count), pa.py_buffer(text_offsets.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


_TYPE = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _told(block: Block) -> pa.StructArray:
    found = words(block, fold=_AS_WRITTEN)
    sizes, rows = np.diff(found.offsets), np.arange(block.rows)
    place = np.arange(len(found.hashes)) + np.repeat(rows, sizes)
    after = found.offsets[1:] + rows
    tokens = np.empty(len(place) + block.rows, np.uint64)
    tokens[place] = found.hashes
    tokens[after] = mix(rows.astype(np.uint64) + np.uint64(1 << 32))
    start, length, period = _runs(tokens, sizes)

    cover = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    kept = np.cumsum(cover[:-1])[place] == 0
    count = np.bincount(np.repeat(rows, sizes)[kept], minlength=block.rows)
    collapsed = _joined(block.data, found.starts[kept], found.ends[kept], count)

    row = np.searchsorted(after, start)
    ends = np.searchsorted(row, np.arange(block.rows + 1)).astype(np.int32)
    entries = pa.StructArray.from_arrays([pa.array(part.astype(np.int64)) for part in (start - (found.offsets[row] + row), length, period)], ["start", "length", "period"])
    return pa.StructArray.from_arrays([pa.array(sizes.astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), entries), collapsed], ["n_words", "runs", "collapsed"])


def _find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    empty = pa.array([], pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))), ("collapsed", pa.string())]))
    for column in texts:
        yield pa.concat_arrays([empty, *(_told(block) for block in blocks(column))])


def runs_of(text: Column) -> Column:
    """The struct of :func:`find_runs` for one text."""
    return F.arrow_udf(_find, _TYPE)(text.cast("binary"))


def find_runs(documents: DataFrame, text_column: str = "text", output: str = "periodic") -> DataFrame:
    """``documents`` with a struct column ``output``: n_words, runs (start, length, period), collapsed.

    Words lie between blanks, tabs, line feeds, vertical tabs, form feeds and carriage returns; they are
    compared as written, each known by a 64-bit hash, and numbered from 0. A run is a stretch of words
    whose smallest period (words so far apart are equal) fits in it four times, of six words at least,
    which no neighbouring word carries on. Runs come by start, then period; they may overlap. ``collapsed`` joins by one blank
    all words but those that some run holds after its first period. A null text, and one without words,
    has no word, no run and an empty ``collapsed``. A text is one row's work whatever its length: time
    grows with its words times the logarithm of them, memory with its words. Each row is told by itself, so repeated rows
    are told alike, and an empty table gives an empty one. A column named ``output`` raises ValueError; other columns pass through.
    """
    if output in documents.columns:
        raise ValueError(f"there is a column {output} already")
    session_of(documents)
    return documents.withColumn(output, runs_of(F.col(text_column)))
