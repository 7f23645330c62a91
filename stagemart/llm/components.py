"""Connected components by alternating star contraction, all of it in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagemart.llm.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, label: str = "edges") -> DataFrame:
    """The smallest node that each node of ``edges`` (a long, b long) reaches: (node, component).

    Each round every node links its larger neighbours to its smallest one, then its smaller ones
    likewise, which takes a logarithmic number of rounds. A hub is an aggregate with map-side
    combine and a join that adaptive execution can split; each round's links are a written table.
    Nodes without an edge, and edges with a null end, are absent.
    """

    def stars(links: DataFrame, both: bool) -> DataFrame:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        out = down.union(down.select(F.col("b").alias("a"), F.col("a").alias("b"))) if both else down
        least = out.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        joined = out.join(least, "a")
        if both:  # large star: the larger neighbours move to the smallest node around
            moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        else:  # small star: the smaller neighbours and the node itself move
            moved = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        return moved.where("a <> b").distinct()

    # a digest of the links, which stays only when a round changed none
    state = {"links": F.count(F.lit(1)), "ends": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))}
    first = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links, before = scratch.keep_observed(first, label, **state)
    while before["links"]:
        grown, now = scratch.keep_observed(stars(stars(links, True), False), label, **state)
        scratch.drop(links)
        links = grown
        if now == before:
            break
        before = now
    return links.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def forest_roots(parents: DataFrame, scratch: Scratch, label: str = "parents") -> DataFrame:
    """The root of each node's tree, (node, component), for links (a long, b long) of at most one b to an a.

    Pointers jump to where their ends point, so the rounds are the logarithm of the depth; a root
    that many nodes point to is the left side of an outer join, which adaptive execution splits.
    ``b`` must not lead back to ``a``.
    """
    held = scratch.keep(parents.select("a", "b").distinct(), label)
    moved = True
    while moved:
        ends = held.select(F.col("a").alias("b"), F.col("b").alias("end"))
        jumped = held.join(ends, "b", "left").select("a", F.coalesce("end", "b").alias("b"), F.col("end").isNotNull().alias("moved"))
        grown, said = scratch.keep_observed(jumped, label, moved=F.max("moved"))
        scratch.drop(held)
        held, moved = grown, said["moved"]
    roots = held.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return held.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
