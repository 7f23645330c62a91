"""Merkle manifests of datasets: few levels are stored, the others computed anew where a proof asks for them."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from stagemart.llm.scratch import Scratch
from stagemart.llm.shipping import session_of


@dataclass(frozen=True)
class MerkleOptions:
    """``fan`` nodes in a row become one of the next level; every ``stored``-th level is written, leaves first."""

    fan: int = 8
    stored: int = 3

    @property
    def block(self) -> int:
        """Nodes of a stored level under one node of the next stored level."""
        return self.fan**self.stored


_PROOF = ArrayType(StructType().add("before", "string").add("after", "string"))
_PROOF_TYPE = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def row_digest(columns: list[Column]) -> Column:
    """sha256, as binary, of the values one after the other: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value as text."""
    said = [F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")) for value in (column.cast("string") for column in columns)]
    return F.unhex(F.sha2(F.concat(*said), 256))


def folded(digest: Column, proof: Column) -> Column:
    """The root, as hex text, that a leaf's binary digest and a proof lead to."""
    return F.aggregate(proof, F.lower(F.hex(digest)), lambda below, step: F.sha2(F.concat(step["before"], below, step["after"]), 256))


def _combined(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _levels(nodes: list[str], size: int, options: MerkleOptions) -> list[list[str]]:
    """The levels over one block, the given one first: up to the next stored level, or to the one node left of a group that ends here.

    ``size`` counts the nodes of the whole group on this level.
    """
    levels = [nodes]
    while len(levels) <= options.stored and (size > options.block or len(levels[-1]) > 1):
        below = levels[-1]
        levels.append([_combined(below[at : at + options.fan]) for at in range(0, len(below), options.fan)])
    return levels


def _in_order(table: pa.Table) -> tuple[pa.Table, list[str]]:
    table = table.sort_by("idx")
    return table, [digest.hex() for digest in table["digest"].to_pylist()]


_LEVEL = "grp string, idx long, size long, digest binary, done boolean"


def _built(leaves: DataFrame, options: MerkleOptions, scratch: Scratch) -> list[DataFrame]:
    """The stored levels over ``leaves`` (grp, idx, size, digest, ...), which come first; ``done`` marks the last node of a group."""

    def fold(table: pa.Table) -> pa.Table:
        table, nodes = _in_order(table.select(["grp", "block", "idx", "size", "digest"]))
        size, block = table["size"][0].as_py(), table["block"][0].as_py()
        top = _levels(nodes, size, options)[-1]
        left = -(-size // options.block)
        return pa.table(
            {
                "grp": pa.array([table["grp"][0].as_py()], pa.string()), "idx": pa.array([block]), "size": pa.array([left]),
                "digest": pa.array([bytes.fromhex(top[0])], pa.binary()), "done": pa.array([left == 1]),
            }
        )

    stored, open_ = [leaves], True
    while open_:
        below = stored[-1] if len(stored) == 1 else stored[-1].where("not done")
        blocks = below.select("grp", F.expr(f"idx div {options.block}").alias("block"), "idx", "size", "digest").groupBy("grp", "block")
        level, seen = scratch.keep_observed(blocks.applyInArrow(fold, _LEVEL), f"level-{options.stored * len(stored)}", open=F.max(~F.col("done")))
        stored.append(level)
        open_ = bool(seen["open"])
    return stored


def _numbered(rows: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(grp, idx, size, digest, carry) of rows (grp, key, digest, carry): the place of each in its group by key, nulls first, then by digest.

    Rows are dealt by range over all groups, so that a group of any size is spread; the places in
    a task become places in the group by the counts of the tasks before it, a row a task and group.
    """
    dealt = rows.repartitionByRange("grp", "key", "digest").sortWithinPartitions("grp", "key", "digest")
    dealt = dealt.drop("key").withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    dealt = scratch.keep(dealt, f"{label}-dealt")
    group = Window.partitionBy("grp")
    counts = dealt.groupBy("part", "grp").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("part", "grp", (before - F.col("first")).alias("shift"), F.sum("n").over(group).alias("size"))
    placed = dealt.join(counts, ["part", "grp"]).select("grp", (F.col("at") + F.col("shift")).alias("idx"), "size", "digest", "carry")
    numbered = scratch.keep(placed, label)
    scratch.drop(dealt)
    return numbered


def _proved(stored: list[DataFrame], ends: DataFrame, options: MerkleOptions) -> DataFrame:
    """(grp, idx, digest, carry, proof, subroot, root) of each leaf.

    ``ends`` (grp, proof, subroot, root) say what follows above each group's last node. From the last
    stored level down, the interior nodes of each block are computed anew from what is stored under
    them, every node of the block gets its siblings of these levels and those of the block, and the
    nodes in between are forgotten.
    """

    def prove(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, digests = _in_order(nodes)
        levels = _levels(digests, nodes["size"][0].as_py(), options)[:-1]
        steps = [[], []]
        for number, level in enumerate(levels):
            for side in steps:
                side.append([])
            for at in range(len(level)):
                run = at - at % options.fan
                steps[0][number].append("".join(level[run:at]))
                steps[1][number].append("".join(level[at + 1 : run + options.fan]))
        upper = above["proof"][0].as_py()
        tails = [[step["before"] for step in upper], [step["after"] for step in upper]]
        sides = [
            [text for at in range(len(digests)) for text in [*(side[number][at // options.fan**number] for number in range(len(levels))), *tail]]
            for side, tail in zip(steps, tails)
        ]
        each = len(levels) + len(upper)
        pairs = pa.StructArray.from_arrays([pa.array(side, pa.string()) for side in sides], ["before", "after"])
        proof = pa.ListArray.from_arrays(pa.array(range(0, each * len(digests) + 1, each) if each else [0] * (len(digests) + 1), pa.int32()), pairs)
        known = {name: pa.array([above[name][0].as_py()] * len(digests), pa.string()) for name in ("subroot", "root")}
        names = ["grp", "idx", "digest", "carry"]
        return pa.table({**{name: nodes[name] for name in names}, "proof": proof.cast(_PROOF_TYPE), **known})

    found = None
    for number in range(len(stored) - 2, -1, -1):
        level = stored[number]
        nodes = level if number == 0 else level.where("not done").withColumn("carry", F.lit(None).cast("boolean"))
        schema = StructType().add("grp", "string").add("idx", "long").add("digest", "binary").add("carry", nodes.schema["carry"].dataType)
        schema = schema.add("proof", _PROOF).add("subroot", "string").add("root", "string")
        nodes = nodes.select("grp", F.expr(f"idx div {options.block}").alias("block"), "idx", "size", "digest", "carry")
        ended = stored[number + 1].where("done").select("grp").join(ends, "grp").select("grp", F.lit(0).cast("long").alias("block"), "proof", "subroot", "root")
        above = ended if found is None else ended.union(found.select("grp", F.col("idx").alias("block"), "proof", "subroot", "root"))
        found = nodes.groupBy("grp", "block").cogroup(above.groupBy("grp", "block")).applyInArrow(prove, schema)
    return found


@dataclass(frozen=True)
class Manifest:
    """Stored levels of every group's tree, the tree over their subroots, and its root as hex text (null without rows)."""

    levels: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: str | None
    options: MerkleOptions

    def proofs(self) -> DataFrame:
        """(grp, idx, digest, carry, proof, subroot, root) of each leaf; ``proof`` holds the siblings before and after on each level, from the leaf up.

        Digests in proofs are hex text, joined; a node alone in its run has two empty sides.
        """
        spark = self.subroots.sparkSession
        over = StructType().add("grp", "string").add("proof", _PROOF).add("subroot", "string").add("root", "string")
        over = spark.createDataFrame([("", [], None, self.root)], over)
        ends = _proved(self.top, over, self.options).select(F.col("carry").alias("grp"), "proof", F.lower(F.hex("digest")).alias("subroot"), "root")
        return _proved(self.levels, ends, self.options)


def build_manifest(
    rows: DataFrame, group: Column, key: Column, digest: Column, carry: Column, options: MerkleOptions = MerkleOptions()
) -> Manifest:
    """Trees over the binary ``digest`` of all rows, one for each ``group`` (text; null is a group) in order of ``key``, and one over their roots.

    ``options.fan`` nodes in a row become the sha256 of their hex texts, the last run as many as are left,
    until one remains, which in a group of one row is the leaf. Roots of groups are ordered null first,
    then bytewise. Rows of a null key come first, and those of an equal key in order of digest; rows equal
    in both can change places without a change of any node. ``carry`` is handed on to the proofs. A group of
    any size is spread over tasks. An empty table has no root and no proofs.
    """
    scratch = Scratch(session_of(rows), "merkle")
    label = F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))
    leaves = rows.select(label.alias("grp"), key.alias("key"), digest.alias("digest"), carry.alias("carry"))
    levels = _built(_numbered(leaves, scratch, "leaves"), options, scratch)
    subroots = None
    for level in levels[1:]:
        ended = level.where("done").select("grp", "digest")
        subroots = ended if subroots is None else subroots.union(ended)
    over = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("key"), "digest", F.col("grp").alias("carry"))
    top = _built(_numbered(over, scratch, "subroots"), options, scratch)
    found = top[-1].where("done").first()
    return Manifest(levels, subroots, top, found and found["digest"].hex(), options)
