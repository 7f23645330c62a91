"""Words, hashes and shingles of whole Arrow columns of text, by numpy on the bytes.

Texts are cut into blocks of bounded size, a longer text being a block of its own, so that memory
follows the block and not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_ORDER = np.array([pow(0xD6E8FEB86659FD93, power, 1 << 64) for power in range(1, 65)], np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Everything but blank, tab, line feed, vertical tab, form feed and carriage return.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Digits, letters a to z after lower-casing, and all beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True


class Block(NamedTuple):
    """Some whole texts: their first row in the column, the bytes, and where each text starts and ends in them."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """Words of a block: mixed 64-bit hashes, byte positions, and the word at which each text starts."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    column = column.cast(pa.large_binary() if wide else pa.binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data, offsets


def blocks(column: pa.Array, size: int = BLOCK_BYTES, rows: int = 1 << 16) -> Iterator[Block]:
    """The column in blocks of up to ``size`` bytes and ``rows`` texts."""
    if not len(column):
        return
    data, offsets = raw(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), first + rows, len(column))
        yield Block(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def mix(values: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every bit of the result depends on every bit given."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _tables(length: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64; kept for blocks of the usual size."""
    if len(_powers[0]) >= length:
        return _powers
    found = []
    for factor in (_BASE, _INVERSE):
        table = np.full(max(length, BLOCK_BYTES) + 1, factor)
        table[0] = 1
        found.append(np.cumprod(table))
    if length <= 4 * BLOCK_BYTES:
        _powers[:] = found
    return found


def cut(block: Block, kind: np.ndarray = NOT_BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where maximal runs of the bytes of ``kind`` start and end, and the first run of each text."""
    inside = kind[block.data]
    if not inside.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(block.rows + 1, np.int64)
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    borders = block.offsets[(block.offsets > 0) & (block.offsets < len(inside))]
    before[borders] = False
    after[borders - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, block.offsets)


def words(block: Block, kind: np.ndarray = NOT_BLANK, fold: np.ndarray = LOWER) -> Words:
    """Words, each with a hash of its bytes after ``fold``, which lower-cases A to Z unless another is given."""
    starts, ends, offsets = cut(block, kind)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), starts, ends, offsets)
    power, inverse = _tables(len(block.data) + 1)
    sums = np.empty(len(block.data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((fold[block.data].astype(np.uint64) + np.uint64(1)) * power[: len(block.data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    return Words(mix(hashes + (ends - starts).astype(np.uint64)), starts, ends, offsets)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words (of the whole text where it has fewer), and the first of each text."""
    count = np.diff(found.offsets)
    number = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(number)])
    at = np.repeat(found.offsets[:-1] - offsets[:-1], number) + np.arange(offsets[-1])
    held = np.minimum(np.repeat(count, number), size)
    short = bool((held < size).any())
    padded = np.concatenate([found.hashes, np.zeros(size, np.uint64)])
    total = held.astype(np.uint64)
    for step in range(size):
        part = padded[at + step] * _ORDER[step]
        total += np.where(held > step, part, np.uint64(0)) if short else part
    return mix(total), offsets


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The text each element belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
