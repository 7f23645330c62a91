"""Benchmark decontamination: suffix arrays over shards of the training texts, searched for every test suffix."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagemart.llm.scratch import Scratch
from stagemart.llm.shipping import session_of
from stagemart.llm.words import ALPHANUMERIC, blocks, words

#: Words of a benchmark block that is broadcast at a time; a larger benchmark takes several passes.
BLOCK_WORDS = 2_000_000
WINDOW = 13
_SIEVE_BITS = 22
#: Texts in a shard; a longer text is a shard of its own.
_SHARD_BYTES = 8 << 20
_SPANS = "array<struct<item:string,start:long,item_start:long,length:long>>"


def _expanded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which interval each element of the intervals comes from, and the element."""
    sizes = high - low
    source = np.repeat(np.arange(len(low)), sizes)
    return source, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)


def _cut_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items (name, text) to (name, words), as 64-bit hashes; those without a word match nothing and are left out."""
    for batch in batches:
        names, said = [], []
        for block in blocks(batch.column(1)):
            found = words(block, ALPHANUMERIC)
            for row in np.flatnonzero(np.diff(found.offsets)):
                names.append(batch.column(0)[block.first + int(row)].as_py())
                said.append(found.hashes[found.offsets[row] : found.offsets[row + 1]].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(said, pa.binary())], ["name", "words"])


class TestIndex:
    """Some whole benchmark items, ranked once: prefixes by the words and pairs of prefixes they are made of, and all suffixes in order.

    ``numbers`` are the words by rank in ``vocabulary``, a 0 after each item. Windows have numbers of
    their own, one for each different stretch of words, and the items that hold it.
    """

    def __init__(self, names: list[str | None], said: list[bytes], window: int):
        parts = [np.frombuffer(part, np.uint64) for part in said]
        self.names, self.lengths = [name if name is not None else "null" for name in names], np.array([len(part) for part in parts])
        self.vocabulary = np.unique(np.concatenate(parts))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + 1)[:-1]])
        self.numbers = np.zeros(self.lengths.sum() + len(parts), np.int64)
        self.item_of = np.repeat(np.arange(len(parts)), self.lengths + 1)
        self.numbers[np.arange(self.lengths.sum()) + np.repeat(np.arange(len(parts)), self.lengths)] = np.searchsorted(self.vocabulary, np.concatenate(parts)) + 1
        own = np.minimum(self.lengths, window)
        self.shortest = int(own.min())
        self._tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.windows: dict[int, tuple[np.ndarray, int]] = {}  # by length: for each prefix rank the window's number plus one, or 0; and the numbers so far
        held, count = [], 0
        for length in np.unique(own).tolist():
            items = np.flatnonzero(own == length)
            source, start = _expanded(np.zeros(len(items), np.int64), self.lengths[items] - length + 1)
            ranks = self.prefix_ranks(length)
            rank = ranks[self.starts[items[source]] + start]
            told, number = np.unique(rank, return_inverse=True)
            numbered = np.zeros(int(ranks.max()) + 1, np.int64)
            numbered[told] = np.arange(len(told)) + count + 1
            self.windows[length] = numbered, count
            held.append(np.unique((number + count) * len(parts) + items[source]))
            count += len(told)
        held_at, self.window_items = np.divmod(np.concatenate(held), len(parts))
        self.window_offsets = np.searchsorted(held_at, np.arange(count + 1))
        full = self._ranked_whole()
        self.order = np.argsort(full, kind="stable")
        self.order = self.order[self.numbers[self.order] > 0]
        self._prefixes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.digests: dict[bytes, tuple[int, str]] = {}

    @property
    def count(self) -> int:
        return len(self.window_offsets) - 1

    def _paired(self, left: np.ndarray, right: np.ndarray, step: int, table: tuple[int, int]) -> np.ndarray:
        """Ranks, from 1, of ``left`` followed ``step`` words on by ``right``; 0 where the benchmark has no such pair."""
        after = np.zeros_like(right)
        after[: len(right) - step] = right[step:]
        if table not in self._tables:
            most = int(right.max(initial=0)) + 1
            both = (left > 0) & (after > 0)
            self._tables[table] = np.unique(left[both] * most + after[both]), np.array(most)
        keys, most = self._tables[table]
        out = np.zeros(len(left), np.int64)
        some = np.flatnonzero((left > 0) & (after > 0))
        if len(some) and len(keys):
            wanted = left[some] * int(most) + after[some]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            out[some] = np.where(keys[at] == wanted, at + 1, 0)
        return out

    def prefix_ranks(self, length: int, numbers: np.ndarray | None = None) -> np.ndarray:
        """Ranks by the first ``length`` words of the suffixes of ``numbers``, or of the benchmark; 0 where the benchmark has no such words."""
        powers = [self.numbers if numbers is None else numbers]
        while 2 << (len(powers) - 1) <= length:
            step = 1 << (len(powers) - 1)
            powers.append(self._paired(powers[-1], powers[-1], step, (step, step)))
        found, done = None, 0
        for power in range(len(powers) - 1, -1, -1):
            if length >> power & 1:
                found = powers[power] if found is None else self._paired(found, powers[power], done, (done, 1 << power))
                done += 1 << power
        return found

    def _ranked_whole(self) -> np.ndarray:
        """Ranks of the whole suffixes to the end of their items, by prefix doubling; a suffix that ends first sorts first."""
        rank, step, longest = self.numbers, 1, int(self.lengths.max())
        while step < longest:
            after = np.zeros_like(rank)
            after[: len(rank) - step] = rank[step:]
            after[rank == 0] = 0
            rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1].astype(np.int64)
            if self.numbers.all():
                rank += 1
            step *= 2
        return rank

    def longest(self, numbers: np.ndarray, at: np.ndarray, prefix: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For suffixes of ``numbers`` whose first ``length`` words have the rank ``prefix``: the length of the longest match, and where it lies in the benchmark.

        Each is searched in the suffixes of the benchmark; the longest match is with one of its neighbours there.
        """
        if len(at) > _LOOKED_UP:  # memory follows the part
            parts = [slice(start, start + _LOOKED_UP) for start in range(0, len(at), _LOOKED_UP)]
            found = [self.longest(numbers, at[part], prefix[part], length) for part in parts]
            return tuple(np.concatenate(part) for part in zip(*found))
        if length not in self._prefixes:
            ordered = self.prefix_ranks(length)[self.order]
            known = np.flatnonzero(ordered)  # in ascending order, as prefixes agree with whole suffixes
            self._prefixes[length] = known, ordered[known]
        known, ordered = self._prefixes[length]
        low = known[np.searchsorted(ordered, prefix, "left")]
        high = known[np.searchsorted(ordered, prefix, "right") - 1] + 1
        first, last = low.copy(), high.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            common, less = self._compared(numbers, at[open_], self.order[middle], length)
            low[open_], high[open_] = np.where(less, middle + 1, low[open_]), np.where(less, high[open_], middle)
        best, place = np.full(len(at), -1), np.zeros(len(at), np.int64)
        for neighbour in (low - 1, low):
            inside = np.flatnonzero((neighbour >= first) & (neighbour < last))
            common, _ = self._compared(numbers, at[inside], self.order[neighbour[inside]], length)
            better = inside[common > best[inside]]
            place[better], best[better] = self.order[neighbour[better]], common[common > best[inside]]
        return best, place

    def _compared(self, numbers: np.ndarray, at: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """How many words a suffix of ``numbers`` and one of the benchmark share, the first ``length`` known to, and whether the latter sorts first."""
        common, less, active = np.full(len(at), length), np.zeros(len(at), bool), np.arange(len(at))
        reach = np.arange(16)
        while len(active):
            here, there = (start[active, None] + common[active, None] + reach for start in (at, place))
            own = np.where(here < len(numbers), numbers[np.minimum(here, len(numbers) - 1)], 0)
            other = np.where(there < len(self.numbers), self.numbers[np.minimum(there, len(self.numbers) - 1)], 0)
            differs = (own != other) | (own == 0)
            first = np.argmax(differs, axis=1)
            ended = differs[np.arange(len(active)), first]
            common[active] += np.where(ended, first, len(reach))
            less[active[ended]] = (other < own)[ended, first[ended]]
            active = active[~ended]
        return common, less

    def items_of(self, windows: np.ndarray) -> tuple[np.ndarray, int, str]:
        """The items that hold any of the windows, how many they are, and the digest of their ids; rows with the same windows are told once."""
        _, entry = _expanded(self.window_offsets[windows], self.window_offsets[windows + 1])
        items = np.unique(self.window_items[entry])
        key = hashlib.blake2b(items.tobytes(), digest_size=16).digest()
        if key not in self.digests:
            if len(self.digests) > _DIGESTS_KEPT:
                self.digests.clear()
            names = sorted({self.names[item] for item in items})
            self.digests[key] = len(names), hashlib.sha256(",".join(names).encode()).hexdigest()
        return items, *self.digests[key]


def _segments(column: pa.Array, test: TestIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words per text; and the runs of test words long enough for a window: numbers with a 0 after each run, row and word of each."""
    counts = np.zeros(len(column), np.int64)
    numbers, rows, places = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    last = len(test.vocabulary) - 1
    maybe = np.zeros(1 << _SIEVE_BITS, bool)  # leaves few other words for the exact search
    maybe[test.vocabulary >> np.uint64(64 - _SIEVE_BITS)] = True
    for block in blocks(column):
        found = words(block, ALPHANUMERIC)
        counts[block.first : block.first + block.rows] = np.diff(found.offsets)
        if not len(found.hashes):
            continue
        starts, ends = _runs(maybe[found.hashes >> np.uint64(64 - _SIEVE_BITS)], found.offsets)
        long = ends - starts >= test.shortest
        starts, ends = starts[long], ends[long]
        if not len(starts):
            continue
        source, word = _expanded(starts, ends + 1)
        stop = word == ends[source]
        word = np.minimum(word, len(found.hashes) - 1)
        at = np.minimum(np.searchsorted(test.vocabulary, found.hashes[word]), last)
        row = np.searchsorted(found.offsets, starts, "right")[source] - 1
        numbers.append(np.where(stop | (test.vocabulary[at] != found.hashes[word]), 0, at + 1).astype(np.int32))
        rows.append(row + block.first)
        places.append(word - found.offsets[row])
    return counts, np.concatenate(numbers), np.concatenate(rows), np.concatenate(places)


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs that stay within one text."""
    before = np.concatenate([[False], inside[:-1]])
    before[offsets[:-1][offsets[:-1] < len(inside)]] = False
    after = np.concatenate([inside[1:], [False]])
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


_SEARCHED = f"n_words long, matches {_SPANS}, n_hit long, n_items long, items_sha256 string, hits array<struct<start:long,length:long>>, items array<string>"
_KINDS = [
    ("n_words", pa.int64()), ("matches", pa.list_(pa.struct([("item", pa.string()), ("start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())]))),
    ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()),
    ("hits", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), ("items", pa.list_(pa.string())),
]
_NOTHING = hashlib.sha256(b"").hexdigest()
_DIGESTS_KEPT = 1 << 16
_LOOKED_UP = 1 << 15


def _lists(rows: np.ndarray, count: int, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(count + 1)).astype(np.int32)), values)


def _search(column: pa.Array, test: TestIndex, several: bool) -> pa.Array:
    """One shard: the suffixes of its stretches of benchmark words that begin with a window, in order, searched for every window of the benchmark."""
    counts, numbers, rows, places = _segments(column, test)
    numbers = numbers.astype(np.int64)
    size = len(column)
    cover = np.zeros(len(numbers) + 1, np.int64)
    hit_at, hit_window, hit_long, hit_place = [[np.zeros(0, np.int64)] for _ in range(4)]
    for length, (numbered, first) in test.windows.items():
        ranks = test.prefix_ranks(length, numbers)
        number = numbered[ranks]
        suffixes = np.flatnonzero(number)
        array = suffixes[np.argsort(number[suffixes], kind="stable")]
        last = int(numbered.max())
        low, high = (np.searchsorted(number[array], np.arange(first + 1, last + 1), side) for side in ("left", "right"))
        window, entry = _expanded(low, high)
        at = array[entry]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + length, -1)
        long, place = test.longest(numbers, at, ranks[at], length)
        for part, values in zip((hit_at, hit_window, hit_long, hit_place), (at, window + first, long, place)):
            part.append(values)
    at, window, long, place = (np.concatenate(part) for part in (hit_at, hit_window, hit_long, hit_place))
    start, end = _stretches(np.cumsum(cover[:-1]) > 0)
    row = rows[start] if len(start) else start
    n_hit = np.bincount(row, end - start, size).astype(np.int64)
    # of each stretch the longest match, the first of equal ones
    stretch = np.searchsorted(start, at, "right") - 1
    order = np.lexsort((at, -long, stretch))
    best = order[np.flatnonzero(np.concatenate([[True], stretch[order][1:] != stretch[order][:-1]]))] if len(order) else order
    item = test.item_of[place[best]]
    spans = pa.StructArray.from_arrays(
        [pa.array(test.names, pa.string()).take(pa.array(item)), pa.array(places[at[best]]), pa.array(place[best] - test.starts[item]), pa.array(long[best])],
        ["item", "start", "item_start", "length"],
    )
    n_items, digests = np.zeros(size, np.int64), [_NOTHING] * size
    pairs = np.unique(rows[at] * test.count + window) if len(at) else at
    pair_row, pair_window = np.divmod(pairs, max(1, test.count))
    cuts = np.flatnonzero(np.concatenate([[True], pair_row[1:] != pair_row[:-1], [True]])) if len(pairs) else np.zeros(0, np.int64)
    item_rows, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low, high in zip(cuts[:-1], cuts[1:]):
        own = int(pair_row[low])
        held, n_items[own], digests[own] = test.items_of(pair_window[low:high])
        if several:
            item_rows.append(np.full(len(held), own))
            items.append(held)
    hits = pa.StructArray.from_arrays([pa.array(places[start] if several else start[:0]), pa.array((end - start) if several else start[:0])], ["start", "length"])
    named = pa.array(test.names, pa.string()).take(pa.array(np.concatenate(items)))
    return pa.StructArray.from_arrays(
        [
            pa.array(counts), _lists(row, size, spans), pa.array(n_hit), pa.array(n_items), pa.array(digests, pa.string()),
            _lists(row if several else row[:0], size, hits), _lists(np.concatenate(item_rows), size, named),
        ],
        [name for name, _ in _KINDS],
    )


def _stretches(told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    change = np.diff(np.concatenate([[False], told, [False]]).astype(np.int8))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


_indexes: dict[str, TestIndex] = {}


def _searcher(shared, several: bool):
    def searched(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        name, names, said, window = shared.value
        if name not in _indexes:
            if not several:
                _indexes.clear()
            _indexes[name] = TestIndex(names, said, window)  # once in a worker
        for column in columns:
            found = [_search(column.slice(block.first, block.rows), _indexes[name], several) for block in blocks(column, _SHARD_BYTES)]
            yield pa.concat_arrays([pa.array([], pa.struct(_KINDS)), *found])

    return searched


def _together(searched: pa.Array) -> pa.Array:
    """Words under any hit of several blocks of the benchmark, the number of items, and the digest of their sorted ids."""
    n_hit, n_items, digests = [], [], []
    for row in searched.to_pylist():
        reach = total = 0
        for hit in sorted(row["hits"], key=lambda hit: hit["start"]):
            end = hit["start"] + hit["length"]
            total += max(0, end - max(reach, hit["start"]))
            reach = max(reach, end)
        names = sorted(set(row["items"]))
        n_hit.append(total)
        n_items.append(len(names))
        digests.append(hashlib.sha256(",".join(names).encode()).hexdigest())
    return pa.StructArray.from_arrays([pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digests, pa.string())], ["n_hit", "n_items", "items_sha256"])


def _benchmark_blocks(benchmark: DataFrame, item_column: str, text_column: str, size: int) -> Iterator[tuple[list[str | None], list[bytes]]]:
    """The items, cut in tasks and written, in blocks of about ``size`` words, dealt by hash."""
    scratch = Scratch(session_of(benchmark), "benchmark")
    rows = benchmark.select(F.col(item_column).cast("string").alias("name"), F.col(text_column).cast("binary").alias("text"))
    held, seen = scratch.keep_observed(rows.mapInArrow(_cut_items, "name string, words binary"), "items", words=F.sum(F.octet_length("words")))
    number = -(-(seen["words"] or 0) // (8 * size))
    for block in range(number):
        found = held.where(F.pmod(F.xxhash64("name", "words"), F.lit(number)) == block).toArrow()
        if len(found):
            yield found["name"].to_pylist(), found["words"].to_pylist()


def _searched(documents: DataFrame, benchmark: DataFrame, text_column: str, item_column: str, item_text_column: str, window: int, block_words: int) -> Column:
    spark, text = session_of(documents), F.col(text_column).cast("binary")
    found = list(_benchmark_blocks(benchmark, item_column, item_text_column, block_words))
    parts = [
        F.arrow_udf(_searcher(spark.sparkContext.broadcast((uuid.uuid4().hex, *block, window)), len(found) > 1), _SEARCHED)(text) for block in found
    ]
    if not parts:
        none = [F.array().cast(_SPANS).alias("matches"), F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), F.lit(_NOTHING).alias("items_sha256")]
        return F.struct(_word_count(text).alias("n_words"), *none)
    names = ("n_words", "matches", "n_hit", "n_items", "items_sha256")
    if len(parts) == 1:
        return F.struct(*(parts[0][name].alias(name) for name in names))
    joined = F.struct(*(F.concat(*(part[name] for part in parts)).alias(name) for name in ("hits", "items")))
    sums = F.arrow_udf(_together, "n_hit long, n_items long, items_sha256 string")(joined)
    return F.struct(
        parts[0]["n_words"].alias("n_words"), F.concat(*(part["matches"] for part in parts)).alias("matches"), *(sums[name].alias(name) for name in names[2:])
    )


def _word_count(text: Column) -> Column:
    def counted(column: pa.Array) -> pa.Array:
        total = np.zeros(len(column), np.int64)
        for block in blocks(column):
            total[block.first : block.first + block.rows] = np.diff(words(block, ALPHANUMERIC).offsets)
        return pa.array(total)

    return F.arrow_udf(counted, "long")(text)


def contaminated(n_words: Column, n_hit: Column, share: int = 20) -> Column:
    """At least one word in ``share`` lies in a match."""
    return (n_hit > 0) & (share * n_hit >= n_words)


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, text_column: str = "text", output: str = "contamination", item_column: str = "item_id",
    item_text_column: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``documents`` with a struct column ``output``: n_words, matches, n_hit, n_items, items_sha256, contaminated.

    Words are runs of digits, letters and bytes beyond ASCII after lower-casing A to Z. A window is ``window`` words of a
    benchmark item in a row (the whole item, where it has fewer); ``n_hit`` counts the words of the text that lie in a stretch that
    equals a window, ``n_items`` the items whose windows occur, and ``items_sha256`` digests their ids, sorted as strings and
    joined by commas. For each stretch of such words, ``matches`` has the longest that equals a stretch of an item: item,
    start in the text, start in the item, length, all in words; with a larger benchmark, for each of its blocks.

    Each shard of the texts has an array of its suffixes that begin with a window, in which every window is searched; the
    benchmark, cut in tasks, comes in blocks of about ``block_words`` that every worker ranks once; so no row moves. Equal windows are
    one, however many items hold them. Null and empty texts have no words; an item that repeats counts under each id; a null
    id reads ``null``. An empty benchmark matches nothing, and an empty table gives an empty one. Whole texts are read, however long;
    repeated rows get the same answer each. A column named ``output`` raises ValueError; other columns pass through.
    """
    if output in documents.columns:
        raise ValueError(f"there is a column {output} already")
    found = documents.withColumn(output, _searched(documents, benchmark, text_column, item_column, item_text_column, window, block_words))
    held = F.col(output)
    return found.withColumn(output, held.withField("contaminated", contaminated(held["n_words"], held["n_hit"])))
