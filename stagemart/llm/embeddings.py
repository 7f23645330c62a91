"""Embedding near-duplicates by a pigeonhole join over blocks of rotated vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagemart.llm.components import connected_components
from stagemart.llm.scratch import Scratch
from stagemart.llm.shipping import session_of

#: On squared distances: above the rounding of doubles, and of floats in the products that look for candidates.
_EXACT_SLACK, _FLOAT_SLACK = 1e-9, 1e-5
_CHECKED_AT_ONCE = 1 << 15
_ROWS_AT_ONCE = 256


@dataclass(frozen=True)
class EmbeddingOptions:
    """Vectors link at a cosine of ``cosine`` or more. ``block_dims`` dimensions make a block;
    ``tile_rows`` vectors of a slab, on average, are one side of a task."""

    cosine: float = 0.95
    block_dims: int = 16
    tile_rows: int = 16384


class _Blocks:
    """Rotation, blocks of dimensions, and the share of the squared distance that each may use."""

    def __init__(self, dims: int, options: EmbeddingOptions):
        drawn = np.random.default_rng(dims).standard_normal((dims, dims))
        self.rotation = np.linalg.qr(drawn)[0].T.copy()
        self.parts = np.array_split(np.arange(dims), math.ceil(dims / options.block_dims))
        whole = 2 - 2 * options.cosine
        self.budgets = [whole * len(part) / dims + _EXACT_SLACK for part in self.parts]

    def rotated(self, unit: np.ndarray) -> np.ndarray:
        """By plain sums of products, so that a vector gives the same bits in every task."""
        return np.einsum("ij,kj->ik", unit, self.rotation)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _checked(kind: np.dtype):
    """Bytes of each vector that can link; null for the others."""

    def check(column: pa.Array) -> pa.Array:
        found: list[bytes | None] = []
        offsets = np.asarray(column.offsets, np.int64)
        inner = column.values
        values = np.asarray(inner.fill_null(np.nan).to_numpy(zero_copy_only=False), kind)
        for start, end, valid in zip(offsets[:-1], offsets[1:], column.is_valid().to_pylist()):
            vector = values[start:end]
            wide = vector.astype(np.float64)
            with np.errstate(over="ignore"):
                norm = float(wide @ wide) if valid and len(vector) else 0.0
            found.append(vector.tobytes() if norm > 0 and math.isfinite(norm) else None)
        return pa.array(found, pa.binary())

    return check


def _vectors(column: pa.Array | pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    return np.stack([np.frombuffer(each, kind) for each in column.to_pylist()]).astype(np.float64)


def _slabs(kind: np.dtype, options: EmbeddingOptions):
    """Where each vector lies on the first dimension of each block, in slabs as wide as the block's radius.

    A vector is at home in its slab and a guest in the one below, so neighbours meet once.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, _Blocks] = {}
        for batch in batches:
            ids = np.asarray(batch.column(0))
            sizes = np.array([len(each) // kind.itemsize for each in batch.column(1).to_pylist()])
            for dims in np.unique(sizes).tolist():
                blocks = known.setdefault(dims, _Blocks(dims, options))
                own = np.flatnonzero(sizes == dims)
                turned = blocks.rotated(_unit(_vectors(batch.column(1).take(pa.array(own)), kind)))
                for index, (part, budget) in enumerate(zip(blocks.parts, blocks.budgets)):
                    slab = np.floor(turned[:, part[0]] / (math.sqrt(budget) * (1 + 1e-9))).astype(np.int64)
                    for guest in (False, True):
                        count = len(own)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[own]), pa.array(np.full(count, dims)), pa.array(np.full(count, index)), pa.array(slab - guest), pa.array(np.full(count, guest))],
                            ["id", "dims", "block", "slab", "guest"],
                        )

    return place


def _roots(root: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Join the sets of the pairs; ``root`` names each member's set by its least position."""
    pairs = np.unique(np.stack([root[first], root[second]]), axis=1)
    pairs = pairs[:, pairs[0] != pairs[1]]
    parent = {}

    def top(node: int) -> int:
        while parent.get(node, node) != node:
            parent[node] = parent.get(parent[node], parent[node])
            node = parent[node]
        return node

    for one, other in pairs.T.tolist():
        one, other = top(one), top(other)
        parent[max(one, other)] = min(one, other)
    if parent:
        root = root.copy()
        for node in list(parent):
            root[node] = top(node)
        root = root[root]
    return root


def _compared(kind: np.dtype, options: EmbeddingOptions):
    """Links of the vectors of two tiles of a slab: for each vector their number and the least vector reached."""

    def compare(table: pa.Table) -> pa.Table:
        dims, index, low, high = (table[name][0].as_py() for name in ("dims", "block", "low", "high"))
        table = table.sort_by("id")
        ids, times, tile = (np.asarray(table[name].combine_chunks(), np.int64) for name in ("id", "times", "tile"))
        guest = np.asarray(table["guest"].combine_chunks().to_numpy(zero_copy_only=False), bool)
        blocks = _Blocks(dims, options)
        raw = _vectors(table["vector"], kind)
        norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
        turned = blocks.rotated(raw / norm[:, None])
        own = turned[:, blocks.parts[index]].astype(np.float32)
        square = np.einsum("ij,ij->i", own, own)[:, None]
        ones = np.ones_like(square)
        # the product of a left and a right row is minus the squared distance of their blocks
        left, right = np.hstack([2 * own, -square, -ones]), np.hstack([own, ones, square])
        floor = np.float32(-(blocks.budgets[index] + _FLOAT_SLACK))
        one, other = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        across = right[other].T.copy()
        for start in range(0, len(one), _ROWS_AT_ONCE):
            rows = one[start : start + _ROWS_AT_ONCE]
            near_row, near_other = np.nonzero(left[rows] @ across >= floor)
            a, b = rows[near_row], other[near_other]
            fair = ~(guest[a] & guest[b]) & (a < b if low == high else True)
            a, b = a[fair], b[fair]
            for step in range(0, len(a), _CHECKED_AT_ONCE):
                first, second = a[step : step + _CHECKED_AT_ONCE], b[step : step + _CHECKED_AT_ONCE]
                linked = np.einsum("ij,ij->i", raw[first], raw[second]) / (norm[first] * norm[second]) >= options.cosine
                first, second = first[linked], second[linked]
                # a pair within budget in several blocks counts in the first of them
                mine = np.ones(len(first), bool)
                for earlier in range(index):
                    apart = turned[first][:, blocks.parts[earlier]] - turned[second][:, blocks.parts[earlier]]
                    mine &= np.einsum("ij,ij->i", apart, apart) > blocks.budgets[earlier]
                apart = turned[first][:, blocks.parts[index]] - turned[second][:, blocks.parts[index]]
                mine &= np.einsum("ij,ij->i", apart, apart) <= blocks.budgets[index]
                first, second = first[mine], second[mine]
                if len(first):
                    links += np.bincount(first, times[second], len(ids)).astype(np.int64)
                    links += np.bincount(second, times[first], len(ids)).astype(np.int64)
                    root = _roots(root, first, second)
        some = np.flatnonzero(links)
        return pa.table({"id": pa.array(ids[some]), "links": pa.array(links[some]), "root": pa.array(ids[root[some]])})

    return compare


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", options: EmbeddingOptions = EmbeddingOptions()) -> DataFrame:
    """(id, n_links, component_id, kept) for each row: how many other vectors lie near, and the least id reached.

    The cosine is of the whole vectors in double precision. Unit vectors are turned by a fixed
    rotation and cut into blocks; two within the squared distance 2 - 2 * cosine are within its
    proportional share in some block, so each block is range-joined under its share (slabs of its
    first dimension, then products over the block), and what it finds is checked exactly. A pair
    counts in the first block that holds it. A slab of many vectors, up to all of them, is cut into
    tiles; links are counted where they are found and never listed. Equal vectors are one class
    that counts as often as it occurs.

    A vector that is null, empty or zero, or has a null or non-finite component or norm, links with
    nothing, and vectors of different lengths do not link. Repeated rows are vectors of their own;
    rows of one id are one node. A row without id links with nothing, has a null component and is kept.
    """
    spark = session_of(vectors)
    scratch = Scratch(spark, "embeddings")
    single = dict(vectors.dtypes)[vector_column] == "array<float>"
    kind = np.dtype(np.float32 if single else np.float64)
    column = F.col(vector_column).cast("array<float>" if single else "array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.arrow_udf(_checked(kind), "binary")(column).alias("vector"))
    rows = scratch.keep(rows, "rows")
    able = F.col("id").isNotNull() & F.col("vector").isNotNull()
    classes = rows.where(able).groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("times"))
    # vectors of one id are told apart, so that each finds its own links
    classes = scratch.keep(classes.withColumn("class", F.monotonically_increasing_id()), "classes")

    placed = classes.select("class", "vector").mapInArrow(_slabs(kind, options), "id long, dims long, block long, slab long, guest boolean")
    placed = scratch.keep(placed, "placed")
    key = ["dims", "block", "slab"]
    tiles = placed.groupBy(key).agg(F.ceil(F.count("*") / options.tile_rows).alias("tiles"), F.min("guest").alias("empty")).where("not empty")
    dealt = placed.join(tiles, key).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = dealt.select("id", *key, "guest", "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))
    held = dealt.join(classes.select(F.col("class").alias("id"), "vector", "times"), "id")
    found = held.groupBy(*key, "low", "high").applyInArrow(_compared(kind, options), "id long, links long, root long")
    found = scratch.keep(found, "found")
    scratch.drop(placed)

    name = classes.select(F.col("class"), F.col("id").alias("name"))
    edges = found.where("id <> root").join(name.toDF("id", "a"), "id").join(name.toDF("root", "b"), "root").select("a", "b")
    # the nodes are ids: rows of one id but different vectors are joined by the class's smallest id each
    several = rows.where(able).join(classes.select("vector", F.col("id").alias("b")), "vector").where("id <> b").select(F.col("id").alias("a"), "b")
    joined = connected_components(edges.union(several), scratch)
    sums = found.groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "class")
    of_class = classes.join(sums, "class", "left").select("vector", F.expr("times - 1 + coalesce(links, 0)").alias("n_links"))
    counted = rows.join(of_class.where("vector is not null"), "vector", "left")
    n_links = F.when(able, F.col("n_links")).otherwise(F.lit(0).cast("long"))
    counted = counted.select("id", n_links.alias("n_links")).join(joined.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("component", "id")
    return counted.select("id", "n_links", component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))
