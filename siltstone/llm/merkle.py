"""A Merkle manifest of a table: leaves per row, a tree per language, a root over all languages.

Nodes of a level are dealt into superblocks of ``BLOCK`` neighbours. Upwards, each superblock is
reduced to one node by itself, and these nodes are the next level, until every tree has one.
Downwards, a superblock's nodes are cogrouped with the one outer row they need, which carries the
siblings between the superblock's node and the root; the group finishes its own reduction again,
puts its own siblings before the outer ones and hands the whole path down. At the leaves the same group
also folds every leaf, taken anew where values are not what they were, along its path to a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import kept

#: Neighbouring nodes that make a superblock; a power of two.
BLOCK = 4096
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its lower 33 bits

# Columns that stand for documents: their names in the order in which a leaf holds them.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: A path: the siblings in hex, one after the other, and per level where the sibling stands.
ALONE, RIGHT, LEFT = b"0", b"1", b"2"


def digest(*parts: str) -> str:
    """Lower-case hex SHA-256 of some hex digests in a row."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_within(n: int, block: int) -> int:
    """Levels that one superblock of a tree level with ``n`` nodes is reduced by."""
    return (min(n, block) - 1).bit_length()


def reduce_block(nodes: Sequence[str], levels: int) -> list[list[str]]:
    """All levels of a superblock, its own nodes first; an odd last node is digested alone."""
    found = [list(nodes)]
    for _ in range(levels):
        below = found[-1]
        found.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return found


def paths_within(found: Sequence[Sequence[str]]) -> list[tuple[str, bytes]]:
    """For every node of a superblock its siblings and their sides, up to the superblock's node."""
    paths = []
    for i in range(len(found[0])):
        siblings, sides = [], []
        for nodes in found[:-1]:
            other = i ^ 1
            if other < len(nodes):
                siblings.append(nodes[other])
                sides.append(RIGHT if other > i else LEFT)
            else:
                sides.append(ALONE)
            i //= 2
        paths.append(("".join(siblings), b"".join(sides)))
    return paths


def fold(node: str, siblings: str, sides: bytes) -> str:
    """The root that a node and the siblings on its way up give."""
    at = 0
    for side in sides:
        if side == ALONE[0]:
            node = digest(node)
            continue
        other = siblings[at : at + 64]
        node = digest(node, other) if side == RIGHT[0] else digest(other, node)
        at += 64
    return node


# -- levels -------------------------------------------------------------------

_NODES = "tree long, position long, n long, node string"
_PATHS = "tree long, position long, n long, node string, top string, siblings string, sides binary"


def _blocked(nodes: DataFrame, block: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("position") / block))


def _above(nodes: DataFrame, block: int) -> DataFrame:
    """The next level of superblocks: (tree, position, n, node) from the same columns."""

    def climb(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("position")
        n = int(group["n"].iloc[0])
        top = reduce_block(group["node"].tolist(), levels_within(n, block))[-1]
        return pd.DataFrame(
            {
                "tree": group["tree"].iloc[:1].to_numpy(),
                "position": group["block"].iloc[:1].to_numpy(),
                "n": [-(-n // block)],
                "node": top,
            }
        )

    return _blocked(nodes.select("tree", "position", "n", "node"), block).groupBy("tree", "block").applyInPandas(
        climb, _NODES
    )


def _with_paths(nodes: DataFrame, outer: DataFrame, block: int) -> DataFrame:
    """Nodes with their paths to the root, from the paths of their superblocks' nodes."""

    def descend(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own, paths = _own_paths(own, above, block)
        return own.drop(columns="block").assign(
            top=above["top"].iloc[0], siblings=[s for s, _ in paths], sides=[d for _, d in paths]
        )

    return _cogrouped(nodes, outer, block).applyInPandas(descend, _PATHS)


def _cogrouped(nodes: DataFrame, outer: DataFrame, block: int):
    above = outer.select("tree", F.col("position").alias("block"), "top", "siblings", "sides")
    return _blocked(nodes, block).groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))


def _own_paths(own: pd.DataFrame, above: pd.DataFrame, block: int) -> tuple[pd.DataFrame, list[tuple[str, bytes]]]:
    """A superblock's nodes in order, and for each the siblings and sides all the way to the root."""
    own = own.sort_values("position")
    siblings, sides = above["siblings"].iloc[0], above["sides"].iloc[0]
    found = reduce_block(own["node"].tolist(), levels_within(int(own["n"].iloc[0]), block))
    return own, [(s + siblings, d + sides) for s, d in paths_within(found)]


def _levels(leaves: DataFrame, largest: int, block: int) -> list[DataFrame]:
    """The written levels of superblock nodes above the leaves; the last one holds one node per tree."""
    levels = []
    while largest > 1 or not levels:
        levels.append(kept(_above(levels[-1] if levels else leaves, block), "merkle-level"))
        largest = -(-largest // block)
    return levels


# -- leaves -------------------------------------------------------------------


def _stated(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _leaf(values: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*(_stated(values[f]) for f in FIELDS)), 256)


def _placed(docs: DataFrame, current: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Leaves with their tree and position, and (tree, lang, n) of all trees, in language order.

    Rows are sorted by ranges of (lang, doc_id, leaf) and written, since recomputed ranges could number
    differently; the number of a row in its partition, and the rows of its language in partitions
    before, give its position. No language is gathered in a task.
    """
    values = {f: docs[f] for f in FIELDS}
    differs = F.lit(False)
    for field, value in current.items():
        differs = differs | ~value.eqNullSafe(values[field])
    order = ["lang", "doc_id", "leaf"]
    rows = kept(
        docs.select(
            docs["doc_id"],
            docs["lang"].cast("string").alias("lang"),
            _leaf(values).alias("leaf"),
            F.when(differs, _leaf({**values, **current})).alias("changed"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()),
        "merkle-leaves",
    )
    # NULL languages get a key of their own, so joins are plain ones.
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))).withColumn(
        "part", F.shiftright("at", _ROW_BITS)
    )
    runs = kept(
        rows.groupBy("key", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"), F.min("lang").alias("lang")),
        "merkle-runs",
    )
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    sizes = runs.groupBy("key").agg(F.sum("rows").alias("n"), F.min("lang").alias("lang"))
    # One row per language, sorted in the order of their names.
    trees = kept(
        sizes.repartitionByRange("key").sortWithinPartitions("key").withColumn("at", F.monotonically_increasing_id()),
        "merkle-trees",
    )
    trees = _numbered(trees, "tree")
    place = runs.select("key", "part", "first", "before").join(trees.select("key", "tree", "n"), "key")
    leaves = rows.join(place, ["key", "part"]).select(
        "tree",
        (F.col("at") - F.col("first") + F.col("before")).alias("position"),
        "n",
        F.col("leaf").alias("node"),
        F.col("doc_id").cast("string").alias("doc_id"),  # pandas has no long with NULLs
        "changed",
    )
    return leaves, trees.select("tree", "lang", "n")


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Rows written in the order of ``at`` with dense numbers from 0; needs few partitions and no rows on the driver."""
    part = F.shiftright("at", _ROW_BITS)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    own = F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return rows.withColumn("part", part).join(offsets, "part").withColumn(name, own + F.col("offset")).drop("part", "offset")


def manifest(
    docs: DataFrame, current: Mapping[str, Column] | None = None, proofs: bool = False, block: int = BLOCK
) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of the row's five fields; leaves of a language ascend by doc_id (NULL first, rows that
    share an id by leaf), and pairs of neighbours become their digest until one node, the subroot, is left. Subroots in
    the order of their languages (NULL first) give the root alike. ``proof_sha256`` is the digest of all
    siblings from the leaf to the root; ``proofs`` adds them (``siblings``, and ``sides`` per level: 0 no
    sibling, 1 right, 2 left), as ``fold`` takes them.

    ``current`` maps fields to what they are found to be now; ``folded_root`` is folded from the leaf of
    the current values and the siblings, and ``verified`` tells whether it is the root. NULLs are a value of
    their own. No rows give no rows; other columns are not read.

    A task holds a superblock of ``block`` leaves at a time, whatever the size of a language.
    """
    if block < 2 or block & (block - 1):
        raise ValueError("a superblock has a power of two of nodes")
    leaves, trees = _placed(docs, current or {})
    trees = kept(trees, "merkle-sizes")
    n_trees, largest = trees.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    levels = _levels(leaves, largest, block)
    zero = F.lit(0).cast("long")
    subroots = levels[-1].select(
        zero.alias("tree"), F.col("tree").alias("position"), F.lit(n_trees).cast("long").alias("n"), "node"
    )
    outer = _levels(subroots, n_trees, block)
    top = outer[-1].first()
    root = top["node"] if top else ""

    # Down again: the root has no siblings; then the subroots, the levels of each tree, and the leaves.
    node = F.col("node")
    paths = outer[-1].select(
        "tree", "position", "n", "node", node.alias("top"), F.lit("").alias("siblings"), F.lit(b"").alias("sides")
    )
    for nodes in reversed([subroots, *outer[:-1]]):
        paths = _with_paths(nodes, paths, block)
    paths = paths.select(
        F.col("position").alias("tree"), zero.alias("position"), node.alias("top"), "siblings", "sides"
    )
    for nodes in reversed(levels[:-1]):
        paths = _with_paths(nodes, paths, block)

    columns = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

    def finish(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own, found = _own_paths(own, above, block)
        leaf = own["node"].tolist()
        seen = [now or then for now, then in zip(own["changed"].tolist(), leaf)]
        folded = [fold(node, *path) for node, path in zip(seen, found)]
        made = {
            "doc_id": own["doc_id"].tolist(),
            "leaf": leaf,
            "subroot": above["top"].iloc[0],
            "root": root,
            "proof_sha256": [digest(s) for s, _ in found],
            "folded_root": folded,
            "verified": [f == root for f in folded],
        }
        if proofs:
            made |= {"siblings": [s for s, _ in found], "sides": [d for _, d in found]}
        return pd.DataFrame(made)

    done = _cogrouped(leaves, paths, block).applyInPandas(
        finish, columns + (", siblings string, sides binary" if proofs else "")
    )
    return done.withColumn("doc_id", F.col("doc_id").cast("long"))
