"""Best-fit packing under conflicts: bins ordered by what is left, with bitmaps of the sources and copies they hold."""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagemart.llm.scratch import Scratch
from stagemart.llm.shipping import session_of
from stagemart.llm.words import blocks, cut

_LOCAL_BITS = 24


@dataclass(frozen=True)
class PackingOptions:
    """``capacity`` of a bin; ``per_source`` pieces of one source and one piece of each cluster of
    copies at most in a bin; ``group_rows`` rows that are packed together, on average."""

    capacity: int = 4096
    per_source: int = 4
    group_rows: int = 4096


def word_count(text: Column) -> Column:
    """Words of each whole text between blanks; null has none."""

    def counted(column: pa.Array) -> pa.Array:
        total = np.zeros(len(column), np.int64)
        for block in blocks(column):
            total[block.first : block.first + block.rows] = np.diff(cut(block)[2])
        return pa.array(total)

    return F.arrow_udf(counted, "long")(text.cast("binary"))


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int) -> tuple[list[int], list[int]]:
    """Bin and place in it of each piece, taken in the given order.

    Bins are kept in order of what is left of them. From the first that has room, the search goes
    on to the next until the source and the cluster are free in it; so the piece goes to the
    tightest bin that may take it, the earliest opened of equal ones, or opens another.
    ``clusters`` below zero conflict with nothing. A bin holds one bitmap of clusters and
    ``per_source`` bitmaps of sources, which count in unary.
    """
    order: list[tuple[int, int]] = []
    cluster_bits: list[int] = []
    source_bits: list[list[int]] = []
    bins, places = [], []
    for length, source, cluster in zip(lengths, sources, clusters):
        source_bit, cluster_bit = 1 << source, 1 << cluster if cluster >= 0 else 0
        at = bisect_left(order, (length, -1))
        while at < len(order):
            index = order[at][1]
            if not cluster_bits[index] & cluster_bit and not source_bits[index][-1] & source_bit:
                break
            at += 1
        if at < len(order):
            left, index = order.pop(at)
        else:
            left, index = capacity, len(cluster_bits)
            cluster_bits.append(0)
            source_bits.append([0] * per_source)
        cluster_bits[index] |= cluster_bit
        planes = source_bits[index]
        for plane in range(per_source):
            if not planes[plane] & source_bit:
                planes[plane] |= source_bit
                break
        bins.append(index)
        places.append(capacity - left)
        if left > length:
            insort(order, (left - length, index))
    return bins, places


def _pack_group(table: pa.Table, capacity: int, per_source: int) -> pa.Table:
    """All pieces of a group: the rests by best fit, full ones in bins of their own, and rows of no length."""
    ids, total = table["id"].combine_chunks(), np.asarray(table["total"].combine_chunks(), np.int64)
    full, rest = np.maximum(total, 0) // capacity, np.maximum(total, 0) % capacity
    order = np.lexsort((np.asarray(ids.fill_null(0)), -rest))
    order = order[rest[order] > 0]
    sources = np.unique(np.asarray(table["source"].combine_chunks()), return_inverse=True)[1]
    kinds, counts = np.unique(np.asarray(table["cluster"].combine_chunks()), return_inverse=True, return_counts=True)[1:]
    bit = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)  # a copy that is alone in the group meets no other
    bins, places = best_fit(rest[order].tolist(), sources[order].tolist(), bit[kinds[order]].tolist(), capacity, per_source)

    whole = np.repeat(np.arange(len(total)), full)
    empty = np.flatnonzero(total <= 0)
    row = np.concatenate([order, whole, empty])
    piece = np.concatenate([full[order], np.arange(len(whole)) - np.repeat(np.cumsum(full) - full, full), np.zeros(len(empty), np.int64)])
    length = np.concatenate([rest[order], np.full(len(whole), capacity), np.zeros(len(empty), np.int64)])
    opened = max(bins, default=-1) + 1
    number = np.concatenate([np.array(bins, np.int64), opened + np.arange(len(whole)), np.zeros(len(empty), np.int64)])
    place = np.concatenate([np.array(places, np.int64), np.zeros(len(whole) + len(empty), np.int64)])
    none = length == 0
    first = table["group"][0].as_py() << _LOCAL_BITS
    return pa.table(
        {
            "id": ids.take(pa.array(row)), "piece": pa.array(piece, pa.int32()), "length": pa.array(length),
            "bin": pa.array(first + number, mask=none), "place": pa.array(place, mask=none),
        }
    )


def pack(documents: DataFrame, id: Column, length: Column, source: Column, cluster: Column, options: PackingOptions = PackingOptions()) -> DataFrame:
    """Pack the rows into bins: (id long, piece int, length long, bin long, place long), one row a piece.

    A row longer than a bin is cut into full pieces and a rest; a row of no length (or null) gets
    no bin and keeps its one piece with a null bin. Rows are dealt by hash into groups of about
    ``group_rows``, so that a source or a cluster of a third of all rows is a third of each group;
    within a group, the rests are placed longest first, equal ones by id. A full piece fills a bin of
    its own. Every bin holds at most its capacity, ``per_source`` pieces of one source (null is a
    source) and one piece of a cluster (null conflicts with nothing). Repeated rows are packed each; an empty table gives no bin.
    """
    scratch = Scratch(session_of(documents), "packing")
    capacity, per_source = options.capacity, options.per_source
    rows = documents.select(
        id.cast("long").alias("id"), F.coalesce(length.cast("long"), F.lit(0)).alias("total"), F.xxhash64(source).alias("source"),
        cluster.cast("long").alias("cluster"), F.monotonically_increasing_id().alias("own"),
    )
    # written, so that rows have one number each, whichever task is run again
    rows, seen = scratch.keep_observed(rows, "rows", rows=F.count(F.lit(1)))
    groups = max(1, -(-seen["rows"] // options.group_rows))
    rows = rows.withColumn("cluster", F.coalesce("cluster", F.xxhash64("own")))
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("id", "own"), F.lit(groups))).drop("own")

    def packed(table: pa.Table) -> pa.Table:
        return _pack_group(table, capacity, per_source)

    return dealt.groupBy("group").applyInArrow(packed, "id long, piece int, length long, bin long, place long")


def pack_texts(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", options: PackingOptions = PackingOptions()) -> DataFrame:
    """:func:`pack` by words and one end mark for each text that has a word; equal texts are a cluster."""
    session_of(documents)
    text = F.col(text_column)
    counted = documents.select(
        F.col(id_column).alias("id"), word_count(text).alias("words"), F.col(source_column).alias("source"), F.xxhash64(text).alias("cluster")
    )
    length = F.when(F.col("words") > 0, F.col("words") + 1).otherwise(0)
    return pack(counted, F.col("id"), length, F.col("source"), F.col("cluster"), options)
