"""A Merkle manifest of a table that stores only every sixth level.

Rows are leaves; each group of rows has a tree over its leaves in key order, and the
roots of these trees are the leaves of one tree more. Two consecutive nodes become
the hash of both, a last single one the hash of itself, until one node remains.

Only the nodes at the bottom of every ``STEP`` levels are written, grouped in aligned
subtrees of ``2 ** STEP`` nodes: one row per subtree, so no task holds more of a tree.
The nodes between them are never stored. Going up, a subtree's row gives its top node,
a node of the next written level. For proofs, going down, the missing nodes of a subtree
are computed again from its row, the siblings on each path are emitted in front of the
path of the subtree's top, and the nodes are dropped.

Null values hash as ``-``, others as their UTF-8 length, a colon and the value, so an
empty text differs from a null one. Rows with a null key come last in their tree; rows
alike in group and key are ordered by their leaf, and repeated rows are separate leaves.
A null group is a tree of its own. An empty table has no tree, no root and no proof.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from polderbook.llm.common import Scratch, numbered

#: Levels from one written level to the next.
STEP = 6
#: Subtrees that one Arrow batch of proofs covers.
SUBTREES = 16
SIBLINGS = pa.list_(pa.struct([("digest", pa.string()), ("left", pa.bool_())]))
SIBLING_LIST = ArrayType(StructType([StructField("digest", StringType()), StructField("left", BooleanType())]))


def leaf(*values: Column) -> Column:
    """The digest of a row's values, in the order given."""
    texts = [v.cast("string") for v in values]
    parts = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def fold(start: Column, siblings: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    def up(node: Column, sibling: Column) -> Column:
        other = F.coalesce(sibling["digest"], F.lit(""))
        return F.sha2(F.when(sibling["left"], F.concat(other, node)).otherwise(F.concat(node, other)), 256)

    return F.aggregate(siblings, start, up)


def proof_digest(siblings: Column) -> Column:
    """One digest over the siblings, from the leaf up."""
    return F.sha2(F.array_join(F.transform(siblings, lambda s: s["digest"]), ""), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels(nodes: list[str], up: int) -> list[list[str]]:
    """The nodes and the ``up`` levels above them."""
    out = [nodes]
    for _ in range(up):
        nodes = [_hash("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def _levels_from(total: int, turn: int, step: int) -> int:
    """Levels of a tree of ``total`` leaves that lie between written levels ``turn`` and ``turn + 1``."""
    return max(0, min(step, (total - 1).bit_length() - turn * step))


def _subtrees(nodes: DataFrame, *carried: str) -> DataFrame:
    """One row per aligned subtree: tree, total, block, nodes in order (at, digest and what is carried)."""
    node = F.struct(F.col("place").bitwiseAND((1 << STEP) - 1).alias("at"), "digest", *carried)
    return nodes.groupBy("tree", "total", F.shiftright("place", STEP).alias("block")).agg(
        F.array_sort(F.collect_list(node), lambda a, b: (a["at"] - b["at"]).cast("int")).alias("nodes"))


def _digests(subtrees: DataFrame) -> DataFrame:
    return subtrees.select("tree", "total", "block", F.transform("nodes", lambda n: n["digest"]).alias("digests"))


def _tops(subtrees: DataFrame, turn: int) -> DataFrame:
    """The top node of every subtree: tree, total, place, digest."""
    step = STEP

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = batch.column(1).to_pylist()
            found = [levels(digests.as_py(), _levels_from(total, turn, step))[-1][0]
                     for total, digests in zip(totals, batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.string())],
                                             ["tree", "total", "place", "digest"])

    return _digests(subtrees).mapInArrow(top, "tree string, total bigint, place bigint, digest string")


def _paths(subtrees: DataFrame, turn: int) -> DataFrame:
    """``subtrees`` with ``paths``: for each node its siblings up to the subtree's top."""
    names, step = subtrees.columns, STEP

    def regrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SUBTREES):
                some = batch.slice(start, SUBTREES)
                out = []
                for total, nodes in zip(some.column("total").to_pylist(), some.column("nodes"), strict=True):
                    digests = nodes.values.field("digest").to_pylist()
                    grown = levels(digests, _levels_from(total, turn, step))[:-1]
                    out.append([[
                        {"digest": row[place ^ 1] if place ^ 1 < len(row) else None, "left": place & 1 == 1}
                        for row, place in ((row, i >> up) for up, row in enumerate(grown))
                    ] for i in range(len(digests))])
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(out, pa.list_(SIBLINGS))], [*names, "paths"])

    paths = StructField("paths", ArrayType(SIBLING_LIST))
    return subtrees.mapInArrow(regrow, StructType([*subtrees.schema.fields, paths]))


@dataclass
class Trees:
    """The written levels of a set of trees, lowest first, and their roots (tree, total, digest)."""

    written: list[DataFrame]
    roots: DataFrame


@dataclass
class Manifest:
    """The trees of the groups, and the tree over their roots."""

    trees: Trees
    over: Trees


def _grow(rows: DataFrame, keys: list[Column], scratch: Scratch, name: str, *carried: str) -> Trees:
    """Trees over ``rows`` (tree, digest, what is carried, what ``keys`` need), ordered by ``keys`` within a tree."""
    nodes = numbered(rows, "tree", keys, scratch, f"{name}-nodes")
    written = [scratch.write(_subtrees(nodes, *carried), f"{name}-level-0")]
    most = written[0].agg(F.max("total")).first()[0] or 0
    scratch.drop(f"{name}-nodes", f"{name}-nodes-parts")
    while (most - 1) >> STEP * len(written) > 0:
        turn = len(written)
        written.append(scratch.write(_subtrees(_tops(written[-1], turn - 1)), f"{name}-level-{turn}"))
    return Trees(written, scratch.write(_tops(written[-1], len(written) - 1), f"{name}-roots"))


def build(rows: DataFrame, scratch: Scratch, *carried: str) -> Manifest:
    """A manifest of ``rows``: ``tree`` (string), ``key``, ``digest`` and the columns ``carried`` along with a leaf."""
    keys = [F.col("tree"), F.col("key").isNull(), F.col("key"), F.col("digest")]
    trees = _grow(rows.select("tree", "key", "digest", *carried), keys, scratch, "trees", *carried)
    tops = trees.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    return Manifest(trees, _grow(tops, [F.col("name")], scratch, "over", "name"))


def _prove(trees: Trees, above: DataFrame, scratch: Scratch, name: str, *carried: str) -> DataFrame:
    """Each leaf with its path; ``above`` has, for each root, ``tree``, ``path`` and more columns to hand down."""
    more = [c for c in above.columns if c not in {"tree", "path"}]
    tops = above.withColumn("place", F.lit(0).cast("bigint"))
    for turn in reversed(range(len(trees.written))):
        taken = carried if turn == 0 else ()
        known = tops.select(F.col("tree").alias("of"), F.col("place").alias("top"), "path", *more)
        grown = _paths(trees.written[turn], turn)
        rows = (
            grown.join(known, F.col("tree").eqNullSafe(F.col("of")) & (F.col("block") == F.col("top")))
            .select("tree", "block", "path", *more, F.explode(F.arrays_zip("nodes", "paths")).alias("each"))
            .select(
                "tree", *more, (F.shiftleft("block", STEP) + F.col("each.nodes.at")).alias("place"),
                *[F.col(f"each.nodes.{c}").alias(c) for c in (("digest",) if turn == 0 else ()) + taken],
                F.concat("each.paths", "path").alias("path"))
        )
        tops = rows if turn == 0 else scratch.write(rows, f"{name}-paths-{turn}")
    return tops


def proofs(manifest: Manifest, scratch: Scratch, *carried: str) -> DataFrame:
    """One row per leaf: tree, digest, place, subroot, root, path, and the columns ``carried``.

    ``path`` lists, from the leaf up to the root of all, the sibling's digest (null where
    there is none) and whether it stands left.
    """
    none = F.array().cast(SIBLING_LIST)
    top = manifest.over.roots.select("tree", F.col("digest").alias("root"), none.alias("path"))
    over = _prove(manifest.over, top, scratch, "over", "name").select(
        F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    return _prove(manifest.trees, scratch.write(over, "subroots"), scratch, "trees", *carried)
