"""Merkle proofs against a plain tree."""

import hashlib

import pytest
from pyspark.sql import functions as F

from stagemart.llm.merkle import MerkleOptions, build_manifest, folded, row_digest

COLUMNS = "doc_id long, lang string, text string, grp string, digest string, carry int"


def _h(said):
    return hashlib.sha256(said.encode()).hexdigest()


def _leaf(values):
    return _h("".join("-" if value is None else f"{len(str(value).encode())}:{value}" for value in values))


def _tree(nodes, fan):
    """The last node, and the siblings before and after on each level for each of ``nodes``."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for proof, place in zip(proofs, at):
            run = place - place % fan
            proof.append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + fan])))
        nodes = [_h("".join(nodes[start : start + fan])) for start in range(0, len(nodes), fan)]
        at = [place // fan for place in at]
    return nodes[0], proofs


def _expected(rows, fan):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(((row[0] is not None, row[0] or 0), _leaf(row[:3]), row[0]))
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in order:
        groups[lang].sort(key=lambda leaf: leaf[:2])
    trees = {lang: _tree([leaf for _, leaf, _ in groups[lang]], fan) for lang in order}
    root, above = _tree([trees[lang][0] for lang in order], fan)
    found = []
    for lang, over in zip(order, above):
        for (_, leaf, ident), proof in zip(groups[lang], trees[lang][1]):
            found.append((ident, leaf, tuple(proof + over), trees[lang][0], root, root))
    return sorted(found, key=repr)


def _found(spark, rows, options, shuffles=4):
    frame = spark.createDataFrame(rows, COLUMNS).repartition(shuffles)
    digest = row_digest([F.col("doc_id"), F.col("lang"), F.col("text")])
    manifest = build_manifest(frame, F.col("lang"), F.col("doc_id"), digest, F.col("doc_id"), options)
    proofs = manifest.proofs().withColumn("folded", folded(F.col("digest"), F.col("proof"))).collect()
    told = [(row.carry, row.digest.hex(), tuple(map(tuple, row.proof)), row.subroot, row.root, row.folded) for row in proofs]
    return sorted(told, key=repr), manifest


def _rows():
    sizes = {"en": 140, "de": 65, "É": 9, "z": 8, "a": 1, None: 3, "": 2}
    rows = [(number * 7 % 1009, lang, f"text {number}", "x", "y", 1) for lang, size in sizes.items() for number in range(size)]
    odd = [(None, "en", None), (None, "en", "b"), (5, "en", "tie"), (5, "en", "another"), (6, "en", "twice"), (6, "en", "twice"), (None, None, None), (7, None, "w " * 200_000)]
    return rows + [(*row, "x", "y", 1) for row in odd]


@pytest.mark.parametrize("options", [MerkleOptions(), MerkleOptions(2, 1), MerkleOptions(2, 3), MerkleOptions(3, 2)], ids=str)
def test_proofs_equal_a_plain_tree(spark, options):
    found, manifest = _found(spark, _rows(), options)
    assert found == _expected(_rows(), options.fan) and manifest.root == found[0][4]


@pytest.mark.parametrize("size", [1, 2, 8, 9, 64, 65])
def test_sizes_about_a_power_of_the_fan(spark, size):
    rows = [(number, "en", str(number), None, None, None) for number in range(size)]
    for options in (MerkleOptions(8, 1), MerkleOptions(8, 3)):
        found, manifest = _found(spark, rows, options)
        assert found == _expected(rows, 8)
        assert len(manifest.levels) - 1 <= max(1, size)


def test_only_every_few_levels_are_stored(spark):
    rows = [(number, "en", str(number), None, None, None) for number in range(65)]
    assert [len(_found(spark, rows, MerkleOptions(2, stored))[1].levels) for stored in (1, 3, 7)] == [8, 4, 2]


def test_a_changed_row_does_not_fold_to_the_root(spark):
    frame = spark.createDataFrame(_rows(), COLUMNS)
    own, other = (row_digest([F.col("doc_id"), F.col("lang"), text]) for text in (F.col("text"), F.concat(F.col("text"), F.lit("!"))))
    manifest = build_manifest(frame, F.col("lang"), F.col("doc_id"), own, F.struct(other.alias("other"), F.col("text")))
    proofs = manifest.proofs().withColumn("folded", folded(F.col("carry.other"), F.col("proof"))).collect()
    assert all((row.folded == row.root) == (row.carry.text is None) for row in proofs)


def test_many_groups_and_no_rows(spark):
    rows = [(number, f"l{number % 150}", str(number), None, None, None) for number in range(400)]
    assert _found(spark, rows, MerkleOptions(4, 2))[0] == _expected(rows, 4)
    empty, manifest = _found(spark, [], MerkleOptions())
    assert empty == [] and manifest.root is None
