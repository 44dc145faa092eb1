"""Merkle manifests of tables: one tree per group of rows, and one over the roots of the groups.

Eight nodes make one of the next level, the last ones of a level fewer. Trees are cut into blocks of three levels, 512 nodes
at the bottom and one at the top, that never straddle: the tops of the blocks are the bottom of the next tier. A block
is one row; its digests stand in van Emde Boas order, the upper half of its levels first and then every subtree below it,
each laid out in the same way. ``address`` finds a node by arithmetic alone, whatever the size of a page or a cache line.

Every step is a Spark job on blocks: numbering the leaves, building a tier from the one below it, and taking the siblings
of a path from the top tier down. A group of any size is spread over its blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covenant.llm.common import LOWER, UPPER
from covenant.session import scratch_path, written

FAN_OUT = 8
BLOCK_LEVELS = 3
BLOCK_LEAVES = FAN_OUT**BLOCK_LEVELS
DIGEST = 32
HEX = 2 * DIGEST

#: The columns a leaf covers, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: every value with its length before it, or ``-`` if null, so that no two rows share an input."""
    return F.sha2(F.concat(*[_field(v) for v in values]).cast("binary"), 256)


def tree_name(group: Column) -> Column:
    """The name of a group's tree. Names sort as groups do, null first."""
    text = group.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), text))


@cache
def layout(levels: int) -> tuple[np.ndarray, ...]:
    """Addresses in a complete tree of so many levels of nodes: one array per level, from the root down."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    bottom = levels - top
    below = layout(bottom)
    sizes = [(FAN_OUT**n - 1) // (FAN_OUT - 1) for n in (top, bottom)]
    out = list(layout(top))
    for depth in range(bottom):
        nodes = np.arange(FAN_OUT ** (top + depth))
        subtree, inside = nodes // FAN_OUT**depth, nodes % FAN_OUT**depth
        out.append(sizes[0] + subtree * sizes[1] + below[depth][inside])
    return tuple(out)


def address(levels: int, depth: int, node: int) -> int:
    """Place of a node of a tree with ``levels`` levels, counted in digests: subtrees are halved until one node is left."""
    base = 0
    while levels > 1:
        top = levels // 2
        bottom = levels - top
        if depth < top:
            levels = top
            continue
        depth -= top
        subtree, node = divmod(node, FAN_OUT**depth)
        base += (FAN_OUT**top - 1) // (FAN_OUT - 1) + subtree * ((FAN_OUT**bottom - 1) // (FAN_OUT - 1))
        levels = bottom
    return base


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels_above(leaves: Column) -> Column:
    """Levels of nodes above a number of leaves; counted in whole numbers, logarithms would round."""
    out = F.lit(0)
    for level in range(21):
        out = out + (leaves > FAN_OUT**level).cast("int")
    return out


def _block_of(position: str) -> Column:
    return F.shiftright(position, 3 * BLOCK_LEVELS)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (tree and others) with ``position`` in their tree by ``order``, from 0, and the tree's number of ``leaves``.

    Rows are sorted by range over all trees, equal rows too, and each range starts where the ranges before it end, so that a
    tree is never in one task. The result is a table.
    """
    spark = rows.sparkSession
    copies = rows.withColumn("__copy", F.monotonically_increasing_id())
    by = ["tree", *order, "__copy"]
    ranged = copies.repartitionByRange(*by).sortWithinPartitions(*by).drop("__copy")
    at = written(ranged.withColumn("__at", F.monotonically_increasing_id()), scratch_path(spark, "leaves"))
    at = at.withColumn("__range", F.shiftright("__at", 33))
    counts = at.groupBy("tree", "__range").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree",
        "__range",
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__start"),
        F.sum("__rows").over(tree).alias("leaves"),
    )
    placed = at.join(starts, ["tree", "__range"]).withColumn("position", F.col("__at") + F.col("__start"))
    return written(placed.drop("__at", "__range", "__start"), scratch_path(spark, "numbered"))


_BLOCK = "tree string, leaves bigint, block bigint, height int, used int, root string, nodes binary"


def _build(rows: pa.Table) -> pa.Table:
    """One block from its lowest nodes (tree, position, leaf, leaves, height)."""
    by = np.argsort(rows.column("position").to_numpy())
    height = rows.column("height")[0].as_py()
    level = [rows.column("leaf")[int(i)].as_py() for i in by]
    used = len(level)
    levels = [level]
    for _ in range(height):
        level = [_hash("".join(level[i : i + FAN_OUT])) for i in range(0, len(level), FAN_OUT)]
        levels.append(level)
    places = layout(height + 1)
    nodes = np.zeros(((FAN_OUT ** (height + 1) - 1) // (FAN_OUT - 1), DIGEST), np.uint8)
    for depth, digests in enumerate(reversed(levels)):
        nodes[places[depth][: len(digests)]] = np.frombuffer(bytes.fromhex("".join(digests)), np.uint8).reshape(-1, DIGEST)
    return pa.table(
        {
            "tree": rows.column("tree").slice(0, 1).cast(pa.string()),
            "leaves": rows.column("leaves").slice(0, 1),
            "block": pa.array([rows.column("position")[0].as_py() // BLOCK_LEAVES], pa.int64()),
            "height": pa.array([height], pa.int32()),
            "used": pa.array([used], pa.int32()),
            "root": pa.array([level[0]], pa.string()),
            "nodes": pa.array([nodes.tobytes()], pa.binary()),
        }
    )


@dataclass
class Trees:
    """Tiers of blocks, the lowest first, and (tree, leaves, root) of every tree."""

    tiers: list[DataFrame]
    roots: DataFrame


def grow(rows: DataFrame) -> Trees:
    """Trees over ``rows`` (tree, position, leaf, leaves), tier by tier; each tier is a table and has 512 times fewer rows."""
    spark = rows.sparkSession
    most = rows.agg(F.max("leaves")).first()[0] or 0
    level = rows.select("tree", "position", "leaf", "leaves")
    tiers, roots = [], None
    while True:
        above = _levels_above(F.col("leaves")) - BLOCK_LEVELS * len(tiers)
        blocks = (
            level.withColumn("height", F.least(above, F.lit(BLOCK_LEVELS)).cast("int"))
            .groupBy("tree", _block_of("position").alias("block"))
            .applyInArrow(_build, _BLOCK)
        )
        blocks = written(blocks, scratch_path(spark, f"tier{len(tiers)}"))
        tiers.append(blocks)
        ends = _levels_above(F.col("leaves")) <= BLOCK_LEVELS * len(tiers)
        whole = blocks.where(ends).select("tree", "leaves", "root")
        roots = whole if roots is None else roots.union(whole)
        if most <= BLOCK_LEAVES ** len(tiers):
            return Trees(tiers, roots)
        level = blocks.where(~ends).select("tree", F.col("block").alias("position"), F.col("root").alias("leaf"), "leaves")


def pack_path(path: list[tuple[str, str]]) -> bytes:
    """A proof as bytes: per level, the numbers of siblings to the left and to the right, and their digests."""
    out = []
    for left, right in path:
        out.append(bytes([len(left) // HEX, len(right) // HEX]) + bytes.fromhex(left + right))
    return b"".join(out)


def read_path(proof: bytes) -> list[tuple[str, str]]:
    """Siblings to the left and to the right of a path, level by level, as hex."""
    out, at = [], 0
    while at < len(proof):
        left, right = at + 2 + proof[at] * DIGEST, at + 2 + (proof[at] + proof[at + 1]) * DIGEST
        out.append((proof[at + 2 : left].hex(), proof[left:right].hex()))
        at = right
    return out


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings on its way up make."""
    for left, right in path:
        leaf = _hash(f"{left}{leaf}{right}")
    return leaf


def _siblings(give):
    """Cogroup of the children of a block with the block: ``give`` makes a table of their paths, lowest level first."""

    def retrieve(children: pa.Table, blocks: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            raise ValueError(f"no block for positions of {children.column('tree')[0].as_py()!r}")
        block = blocks.slice(0, 1).to_pylist()[0]
        above, height = read_path(block["proof"]), block["height"]
        places = layout(height + 1)
        nodes = np.frombuffer(block["nodes"], np.uint8).reshape(-1, DIGEST)
        levels = []
        for depth in range(height, 0, -1):
            used = -(-block["used"] // FAN_OUT ** (height - depth))
            levels.append((nodes[places[depth][:used]].tobytes().hex(), used))
        paths = []
        for position in children.column("position").to_pylist():
            node, path = position % BLOCK_LEAVES, []
            for digests, used in levels:
                first = node - node % FAN_OUT
                end = min(first + FAN_OUT, used)
                path.append((digests[first * HEX : node * HEX], digests[(node + 1) * HEX : end * HEX]))
                node //= FAN_OUT
            paths.append(path + above)
        return give(children, block, paths)

    return retrieve


def _descend(children: DataFrame, blocks: DataFrame, give, schema: str) -> DataFrame:
    """Paths of ``children`` (tree, position, ...) through the ``blocks`` (with ``proof``) that hold them."""
    number = _block_of("position").alias("block")
    return children.groupBy("tree", number).cogroup(blocks.groupBy("tree", "block")).applyInArrow(_siblings(give), schema)


_PATHS = "tree string, block bigint, proof binary, subroot string"


def _give_path(children: pa.Table, block: dict, paths: list) -> pa.Table:
    return pa.table(
        {
            "tree": children.column("tree").cast(pa.string()),
            "block": children.column("position"),
            "proof": pa.array([pack_path(p) for p in paths], pa.binary()),
            "subroot": pa.array([block["subroot"]] * len(paths), pa.string()),
        }
    )


def block_paths(trees: Trees, above: DataFrame) -> DataFrame:
    """The lowest blocks with ``proof``, the way from the block's root up through its tree and on by ``above`` (tree, proof,
    subroot), and their tree's ``subroot``, from the top tier down."""
    spark = above.sparkSession
    paths = None
    for tier in range(len(trees.tiers) - 1, -1, -1):
        blocks = trees.tiers[tier]
        top = _levels_above(F.col("leaves")) <= BLOCK_LEVELS * (tier + 1)
        found = blocks.where(top).join(above, "tree")
        if paths is not None:
            inner = blocks.where(~top).join(paths, ["tree", "block"])
            found = found.unionByName(inner)
        # The lowest tier is read as it is; the others are read once more for the children of their blocks.
        if tier == 0:
            return found
        found = written(found, scratch_path(spark, "paths"))
        below = _levels_above(F.col("leaves")) > BLOCK_LEVELS * tier
        children = trees.tiers[tier - 1].where(below).select("tree", F.col("block").alias("position"))
        paths = written(_descend(children, found, _give_path, _PATHS), scratch_path(spark, "paths"))
    raise AssertionError


def _give_proofs(claims: bool):
    def give(children: pa.Table, block: dict, paths: list) -> pa.Table:
        columns = {c: children.column(c) for c in children.column_names}
        columns["subroot"] = pa.array([block["subroot"]] * len(paths), pa.string())
        columns["proof_sha256"] = pa.array([_hash("".join(a + b for a, b in p)) for p in paths], pa.string())
        if claims:
            leaves = children.column("claim").to_pylist()
            columns["folded_root"] = pa.array([fold(c, p) for c, p in zip(leaves, paths, strict=True)], pa.string())
        else:
            columns["proof"] = pa.array([pack_path(p) for p in paths], pa.binary())
        return pa.table(columns)

    return give


@dataclass
class Manifest:
    """Trees of the groups, and the tree over their roots: ``top`` has one tree, whose leaves are ``groups`` (tree, position,
    leaf, leaves). ``root`` is null of an empty table."""

    groups: DataFrame
    trees: Trees
    top: Trees
    root: str | None


_TOP = "all"


def build(rows: DataFrame) -> Manifest:
    """The manifest of ``rows`` (tree, position, leaf, leaves), as ``numbered`` gives them; an empty table has no root."""
    trees = grow(rows)
    named = trees.roots.select(F.lit(_TOP).alias("tree"), F.col("tree").alias("group"), F.col("root").alias("leaf"))
    groups = numbered(named, ["group"])
    top = grow(groups)
    found = top.roots.first()
    return Manifest(groups, trees, top, None if found is None else found["root"])


def _group_paths(manifest: Manifest) -> DataFrame:
    """(tree, proof) of every group: the way from its root to the root of all."""
    spark = manifest.groups.sparkSession
    root = spark.createDataFrame([(_TOP, b"", None)], "tree string, proof binary, subroot string")

    def give(children: pa.Table, block: dict, paths: list) -> pa.Table:
        return pa.table(
            {
                "tree": children.column("group").cast(pa.string()),
                "proof": pa.array([pack_path(p) for p in paths], pa.binary()),
                "subroot": children.column("leaf").cast(pa.string()),
            }
        )

    found = _descend(manifest.groups, block_paths(manifest.top, root), give, "tree string, proof binary, subroot string")
    return written(found, scratch_path(spark, "groups"))


def proofs(manifest: Manifest, wanted: DataFrame) -> DataFrame:
    """``wanted`` (tree, position and others) with ``subroot``, the root of their tree, and ``proof_sha256``, the digest of the
    siblings' hex digests from the leaf to the root of all, level by level and left to right.

    With a column ``claim`` (the digest a leaf is said to have) comes ``folded_root``, the root that the claim and the siblings
    make; without it, ``proof``, which ``read_path`` reads. Positions that are in no block are an error.
    """
    claims = "claim" in wanted.columns
    own = wanted.drop("subroot", "proof_sha256", "folded_root", "proof")
    extra = {"subroot": F.lit(""), "proof_sha256": F.lit(""), "folded_root" if claims else "proof": F.lit("" if claims else b"")}
    schema = own.withColumns(extra).schema
    return _descend(own, block_paths(manifest.trees, _group_paths(manifest)), _give_proofs(claims), schema)


def verify(docs: DataFrame, group: str = "lang", key: str = "doc_id", fields: Sequence[str] = FIELDS, tampered: Column | None = None) -> DataFrame:
    """Build the manifest of ``docs`` and check every row against it.

    Rows of a group ascend by ``key`` (null first; rows with equal keys by their digests, so that equal rows are
    interchangeable). Result, one row for each of ``docs``: ``key``, leaf, subroot (of the group), root, proof_sha256, folded_root
    and verified. ``tampered`` says which rows come back with A-Z of their ``text`` in lower case: their own digest is folded with
    the siblings of the manifest, so they fail unless nothing changed. An empty table has no rows. Columns other than ``fields``
    are not read; all of these may be null or empty.
    """
    columns = [F.col(f) for f in fields]
    leaf = leaf_digest(*columns)
    changed = [F.translate("text", UPPER, LOWER) if f == "text" else F.col(f) for f in fields]
    claim = leaf if tampered is None else F.when(F.coalesce(tampered, F.lit(False)), leaf_digest(*changed))
    rows = docs.select(tree_name(F.col(group)).alias("tree"), F.col(key).alias("key"), leaf.alias("leaf"), claim.alias("claim"))
    # Texts are read and digested once: sorting by range reads its input twice.
    rows = written(rows.withColumn("claim", F.coalesce("claim", "leaf")), scratch_path(docs.sparkSession, "digests"))
    placed = numbered(rows, ["key", "leaf"])
    manifest = build(placed.select("tree", "position", "leaf", "leaves"))
    found = proofs(manifest, placed.drop("leaves"))
    return found.select(
        F.col("key").alias(key),
        "leaf",
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == manifest.root if manifest.root else F.lit(None).cast("boolean")).alias("verified"),
    )
