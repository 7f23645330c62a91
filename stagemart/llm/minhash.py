"""MinHash near-duplicates by tensored banding: table keys pair entries of two small hash collections."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagemart.llm.bloom import bloom_of, bloom_size
from stagemart.llm.components import connected_components, forest_roots
from stagemart.llm.scratch import Scratch
from stagemart.llm.shipping import session_of
from stagemart.llm.urls import shard_of
from stagemart.llm.words import BLOCK_BYTES, blocks, shingles, words


@dataclass(frozen=True)
class MinHashOptions:
    """Texts are near-duplicates when ``100 * common >= similarity * all`` of their ``shingle``-word runs.

    Two collections hold ``entries`` keys of ``hashes`` minhashes each; their ``entries ** 2`` pairs are
    the tables. A pair of similarity s is missed with a chance of about 2 (1 - s^hashes)^entries:
    one in 100,000 at 0.8, and far less above it. ``tile_rows`` classes that share an entry are compared in
    one task; more are cut into tiles. ``filter_bits`` bound the filter that keeps texts nobody asks
    for out of the shuffle; more texts than it can tell apart take a pass for each of their shards.
    """

    shingle: int = 5
    similarity: int = 80
    entries: int = 12
    hashes: int = 2
    tile_rows: int = 512
    filter_bits: int = 1 << 25


#: Entries that hold more than one in so many rows; there are at most as many of them.
_HOT = 1024

SIGNED = "id long, n long, print binary, left array<long>, right array<long>, parity binary"


def _minhashes(found: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """``count`` minhashes of 32 bits for each run of ``found`` that begins at ``starts``."""
    random = np.random.default_rng(20_240_229)
    seeds = random.integers(0, 1 << 63, count, np.uint64)
    factors = random.integers(0, 1 << 63, count, np.uint64) | np.uint64(1)
    out = np.empty((len(starts), count), np.uint64)
    for number in range(count):
        out[:, number] = np.minimum.reduceat(((found ^ seeds[number]) * factors[number]) >> np.uint64(32), starts)
    return out


def _parity(own: np.ndarray) -> bytes:
    """The set folded to bits by exclusive or, four or more bits an element.

    Two sets differ in at least as many elements as their folds differ in bits.
    """
    bits = 1 << max(6, int(4 * len(own) - 1).bit_length())
    odd = np.bincount((own >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _signed(options: MinHashOptions):
    half = options.entries * options.hashes

    def keys(low: np.ndarray) -> np.ndarray:
        """The minhashes of an entry as one number."""
        parts = low.reshape(len(low), options.entries, options.hashes)
        key = parts[:, :, 0]
        for number in range(1, options.hashes):
            key = (key << np.uint64(32)) ^ (key >> np.uint64(32)) ^ parts[:, :, number]
        return key.view(np.int64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), BLOCK_BYTES):
                found, offsets = shingles(words(block), options.shingle)
                size = np.zeros(block.rows, np.int64)
                prints: list[bytes | None] = [None] * block.rows
                parities: list[bytes | None] = [None] * block.rows
                full = np.flatnonzero(np.diff(offsets))
                for row in full:
                    own = np.unique(found[offsets[row] : offsets[row + 1]])
                    size[row] = len(own)
                    prints[row] = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                    parities[row] = _parity(own)
                low = _minhashes(found, offsets[full], 2 * half) if len(full) else np.zeros((0, 2 * half), np.uint64)
                number = np.zeros(block.rows + 1, np.int32)
                number[full + 1] = options.entries
                ends = pa.array(np.cumsum(number, dtype=np.int32))
                left, right = (pa.ListArray.from_arrays(ends, pa.array(keys(part).ravel())) for part in (low[:, :half], low[:, half:]))
                ids = batch.column(0).slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(size), pa.array(prints, pa.binary()), left, right, pa.array(parities, pa.binary())],
                    ["id", "n", "print", "left", "right", "parity"],
                )

    return sign


def _shingle_set(text: bytes, size: int) -> frozenset:
    found = text.lower().split()
    if len(found) <= size:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(zip(*(found[step:] for step in range(size))))


def _confirmed(options: MinHashOptions):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, frozenset()  # pairs come ordered by the second text, which many share
        for batch in batches:
            links: list[tuple[int, int]] = []
            for a, b, own, other in zip(*(column.to_pylist() for column in batch.columns)):
                if other != held:
                    held, known = other, _shingle_set(other, options.shingle)
                found = _shingle_set(own, options.shingle)
                common = len(found & known)
                if found and 100 * common >= options.similarity * (len(found) + len(known) - common):
                    links.append((a, b))
            first, second = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], ["a", "b"])

    return confirm


def _verified(pairs: DataFrame, texts: DataFrame, scratch: Scratch, options: MinHashOptions) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets are similar enough. A filter keeps most other texts in their tasks."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    bits, hashes = bloom_size(max(1, 2 * pairs.count()), 1 / 64)
    shards = -(-bits // options.filter_bits)
    found = []
    for number in range(shards):
        own = shard_of(F.col("id"), shards) == number if shards > 1 else F.lit(True)
        wanted = bloom_of(ends.where(own), F.col("id"), 64 * -(-bits // (64 * shards)), hashes)
        wanted = replace(wanted, frame=scratch.keep(wanted.frame, "filter"))
        some = texts.where(own).where(wanted.passes(F.col("id")))
        found.append(some if shards == 1 else scratch.keep(some, "wanted"))  # one filter is sent at a time
    texts = reduce(DataFrame.union, found)
    both = pairs.join(texts.toDF("a", "own"), "a").join(texts.toDF("b", "other"), "b").select("a", "b", "own", "other")
    return both.mapInArrow(_confirmed(options), "a long, b long")


def _folded(folds: list[np.ndarray], width: np.ndarray, wide: int) -> np.ndarray:
    """The folds that are at least so wide, folded on to that width; the others are left empty."""
    out = np.zeros((len(folds), wide), np.uint64)
    for row in np.flatnonzero(width >= wide):
        out[row] = np.bitwise_xor.reduce(folds[row].reshape(-1, wide), axis=0)
    return out


def _across(placed: DataFrame, entries: int, classes: DataFrame, scratch: Scratch, options: MinHashOptions) -> DataFrame:
    """Pairs (a, b) of classes in different components that meet in a table and may be similar enough.

    ``placed`` are the entries (id, i, u, component). Those that classes of several components share
    are compared in tiles, a pair under its first common entry alone, by the second collection,
    sizes and folded sets; only pairs that pass all of these come out. In an entry of many classes
    those of its main component meet the others but not each other: they have tiles of their own,
    numbered below zero, and go to as many tasks as the others have tiles. Of the ``entries`` rows, those whose
    entry holds more than one in ``_HOT`` meet its tiles by a broadcast of that few entries, so that no task reads them all.
    """
    sizes = placed.groupBy("i", "u", "component").agg(F.count("*").alias("rows"))
    shared = sizes.groupBy("i", "u").agg(
        F.max(F.struct("rows", "component")).alias("main"), F.sum("rows").alias("rows"), F.count("*").alias("components")
    )
    split = F.col("rows") > options.tile_rows
    shared = shared.where("components > 1").select(
        "i", "u", (F.col("rows") * _HOT > entries).alias("hot"), F.when(split, F.col("main.component")).alias("main"),
        F.when(split, F.ceil(F.col("main.rows") / options.tile_rows)).otherwise(0).alias("main_tiles"),
        F.greatest(F.lit(1), F.when(split, F.ceil((F.col("rows") - F.col("main.rows")) / options.tile_rows))).alias("tiles"),
    )
    of_main = F.col("component").eqNullSafe(F.col("main"))
    spread = F.xxhash64("id")
    tile = F.when(of_main, -1 - F.pmod(spread, F.greatest(F.lit(1).cast("long"), "main_tiles"))).otherwise(F.pmod(spread, F.col("tiles")))
    others = F.sequence(F.when(of_main, 0).otherwise(-F.col("main_tiles")), F.col("tiles") - 1)
    shared = scratch.keep(shared, "shared")
    hot = F.broadcast(shared.where("hot"))
    met = placed.join(hot, ["i", "u"]).union(placed.join(hot, ["i", "u"], "left_anti").join(shared.where("not hot"), ["i", "u"]))
    dealt = met.withColumn("tile", tile).withColumn("other", F.explode(others))
    dealt = dealt.select("id", "component", "i", "u", "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))
    held = dealt.join(classes.select("id", "n", "left", "right", "parity"), "id")

    def compared(table: pa.Table) -> pa.Table:
        number = {name: np.asarray(table[name].combine_chunks(), np.int64) for name in ("id", "component", "n", "tile")}
        place, low, high = table["i"][0].as_py(), table["low"][0].as_py(), table["high"][0].as_py()
        left, right = (np.asarray(table[name].combine_chunks().flatten(), np.int64).reshape(len(table), -1) for name in ("left", "right"))
        folds = [np.frombuffer(fold, np.uint64) for fold in table["parity"].to_pylist()]
        width = np.array([len(fold) for fold in folds])
        at_width = {wide: _folded(folds, width, wide) for wide in np.unique(width).tolist()}
        own = np.flatnonzero(number["tile"] == low)
        rest = np.flatnonzero(number["tile"] == high)
        size, component = number["n"], number["component"]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for row in own:
            near = (component[rest] != component[row]) & (100 * np.minimum(size[rest], size[row]) >= options.similarity * np.maximum(size[rest], size[row]))
            if low == high:
                near &= number["id"][rest] < number["id"][row]
            some = rest[near]
            if not len(some):
                continue
            some = some[~(left[some, :place] == left[row, :place]).any(axis=1) & (right[some] == right[row]).any(axis=1)]
            differ, narrower = np.zeros(len(some), np.int64), np.minimum(width[some], width[row])
            for wide in np.unique(narrower).tolist():
                same = narrower == wide
                differ[same] = np.bitwise_count(at_width[wide][some[same]] ^ at_width[wide][row]).sum(axis=1, dtype=np.int64)
            # similar enough means that what differs is at most (100 - s) / (100 + s) of both sizes
            some = some[differ * (100 + options.similarity) <= (100 - options.similarity) * (size[some] + size[row])]
            if len(some):
                found.append((np.full(len(some), number["id"][row]), number["id"][some]))
        a, b = (np.concatenate(part) for part in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        return pa.table({"a": pa.array(np.maximum(a, b)), "b": pa.array(np.minimum(a, b))})

    return held.groupBy("i", "u", "low", "high").applyInArrow(compared, "a long, b long")


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", options: MinHashOptions = MinHashOptions()) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row: groups of near-duplicate texts, linked through others too.

    ``n_shingles`` counts the distinct runs of ``shingle`` words; a text of fewer words is one run, a
    null text and one without words have none and link with nothing. Words lie between blanks, A to
    Z in lower case. ``component_id`` is the smallest id reached by links, and ``kept`` says that it is
    the row's own. Rows of one id are one node, whichever texts they have; a row without id is a
    node of its own that keeps a null component and is kept.

    Texts of the same set are one class under their smallest id, so that copies cost no pairs. Each
    class has 2 * entries keys of which the entries^2 table keys are formed, and only where an entry of the
    first collection collides. Each class is checked, on whole texts, against the one among the
    smallest ids of its tables that it meets most often; what that links is contracted. Then
    all pairs that meet in a table and lie in different components are checked, so that none is
    lost because a third text was the smallest.
    """
    spark = session_of(documents)
    scratch = Scratch(spark, "minhash")
    rows = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("binary").alias("text"))
    signed = scratch.keep(rows.mapInArrow(_signed(options), SIGNED), "signed")

    named = signed.where("print is not null and id is not null")
    least = named.groupBy("print").agg(F.min(F.struct("id", "n", "left", "right", "parity")).alias("least"))
    classes = scratch.keep(least.select("print", "least.*"), "classes")

    entries = classes.select("id", F.posexplode("left").alias("i", "u"))
    shared = entries.groupBy("i", "u").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("i", "u")
    met = scratch.keep(entries.join(shared, ["i", "u"]).select("id", "i", "u"), "entries")
    paired = met.join(classes.select("id", "n", "right"), "id").select("id", "n", "i", "u", F.posexplode("right").alias("j", "v"))
    tables = scratch.keep(paired.select(F.xxhash64("i", "u", "j", "v").alias("key"), "id", "n"), "tables")

    first = tables.groupBy("key").agg(F.min(F.struct("id", "n")).alias("first"), F.max("id").alias("last")).where("first.id < last")
    alike = f"id > first.id and 100 * least(n, first.n) >= {options.similarity} * greatest(n, first.n)"
    counted = tables.join(first, "key").where(alike).groupBy("id", F.col("first.id").alias("first")).count()
    best = counted.groupBy("id").agg(F.max(F.struct("count", (-F.col("first")).alias("first"))).alias("best"))
    stars = scratch.keep(best.select(F.col("id").alias("a"), (-F.col("best.first")).alias("b")), "stars")
    texts = rows.where("id is not null and text is not null")
    links = scratch.keep(_verified(stars, texts, scratch, options), "links")
    scratch.drop(tables)

    within = scratch.keep(forest_roots(links, scratch).select(F.col("node").alias("id"), "component"), "within")
    placed, seen = scratch.keep_observed(met.join(within, "id", "left").withColumn("component", F.coalesce("component", "id")), "placed", rows=F.count(F.lit(1)))
    pairs = _across(placed, seen["rows"], classes, scratch, options).join(stars, ["a", "b"], "left_anti")
    pairs = scratch.keep(pairs, "pairs")
    more = scratch.keep(_verified(pairs, texts, scratch, options), "links")
    scratch.drop(met, placed, pairs, stars)

    near = within.select(F.col("id").alias("a"), F.col("component").alias("near_a"))
    far = within.select(F.col("id").alias("b"), F.col("component").alias("near_b"))
    between = more.join(near, "a", "left").join(far, "b", "left").select(F.coalesce("near_a", "a").alias("a"), F.coalesce("near_b", "b").alias("b"))
    joined = connected_components(between, scratch).select(F.col("node").alias("near"), F.col("component").alias("far"))
    of_class = classes.select("print", "id").join(within, "id", "left").select("print", F.coalesce("component", "id").alias("near"))
    of_class = of_class.join(joined, "near", "left").select("print", F.coalesce("far", "near").alias("component"))
    by_id = signed.select("id", "n", "print").join(of_class, "print", "left")
    component = F.coalesce("component", "id")
    return by_id.select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), component).alias("component_id"),
        (F.col("id").isNull() | (component == F.col("id"))).alias("kept"),
    )
