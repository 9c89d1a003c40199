"""A Merkle manifest of a table, as aligned subtrees in van Emde Boas layout.

1. Each row is a leaf: the SHA-256 of its columns, each with its length. The leaves of a tree (rows of one ``lang``)
   are numbered by ``doc_id`` from a range-partitioned sort and the starts of its partitions.
2. ``2 ** HEIGHT`` leaves in a row are an aligned subtree, built in one task whatever else the tree holds. Its nodes
   lie in one binary in van Emde Boas order: the tree is split at half its height, the top comes first, then each
   bottom tree, all laid out in the same way. A node's place follows from its depth and number alone.
3. The roots of the subtrees are the leaves of the next tier, and so on until each tree has one root. The roots
   of the trees, in order of their names, are the leaves of one more tree.
4. Paths go down again: the siblings of a subtree's root are looked up in the subtree above it and handed to its
   nodes. Last, each leaf meets its own subtree, whose siblings complete its proof.

While several nodes remain, two in a row become their hash; a last one without a sibling is hashed alone. A tree of one
leaf is that leaf. Nulls are ``-`` in a leaf; rows with a null ``lang`` are a tree of their own, the first one; a null
``doc_id`` comes before all others. Rows that share an id are ordered by their leaves, so repeated rows are
interchangeable and each of them is a leaf. An empty table has no root and gives no rows. Further columns are not read.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landtiles.session import cut

HEIGHT = 12  # a stored subtree has up to 4096 leaves: 256 KB
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ALONE, RIGHT, LEFT = 0, 1, 2  # where a node's sibling stands
DIGEST = 32
_ROWS_PER_PARTITION_BITS = 33  # layout of monotonically_increasing_id


# ---- nodes


def joined(nodes: list[bytes]) -> bytes:
    """The hash of digests, concatenated as hex text."""
    return sha256(b"".join(nodes).hex().encode()).digest()


def address(levels: int, depth: int, number):
    """Where node ``number`` of a depth lies in the layout of a tree with so many levels of nodes."""
    at = 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth, levels = depth - top, levels - top
        at = at + (1 << top) - 1 + (number >> depth) * ((1 << levels) - 1)
        number = number & ((1 << depth) - 1)
    return at


class Subtree:
    """A binary tree over up to ``2 ** height`` leaves, in one buffer; places without a node are zero."""

    def __init__(self, height: int, size: int, buffer=None):
        self.levels, self.size = height + 1, size
        self.nodes = bytearray(((2 << height) - 1) * DIGEST) if buffer is None else buffer

    @classmethod
    def of(cls, height: int, leaves: list[bytes]) -> tuple["Subtree", bytes]:
        """The tree over the leaves, and its root."""
        tree = cls(height, len(leaves))
        return tree, tree._laid(tree.levels, 0, leaves)

    def _laid(self, levels: int, at: int, leaves: list[bytes]) -> bytes:
        if levels == 1:
            self.nodes[at * DIGEST : (at + 1) * DIGEST] = leaves[0]
            return leaves[0]
        top = levels // 2
        bottom = levels - top
        width, step = 1 << (bottom - 1), (1 << bottom) - 1
        first = at + (1 << top) - 1
        roots = [
            self._laid(bottom, first + step * k, leaves[i : i + width]) for k, i in enumerate(range(0, len(leaves), width))
        ]
        return self._laid(top, at, [joined(roots[i : i + 2]) for i in range(0, len(roots), 2)])

    def paths(self, numbers: np.ndarray) -> np.ndarray:
        """For each of the leaves, level by level: where its sibling stands, and the sibling; 33 bytes a level."""
        nodes = np.frombuffer(self.nodes, np.uint8).reshape(-1, DIGEST)
        found = np.zeros((len(numbers), self.levels - 1, 1 + DIGEST), np.uint8)
        for up in range(self.levels - 1):
            depth = self.levels - 1 - up
            other = (numbers >> up) ^ 1
            there = np.flatnonzero(other < -(-self.size >> up))
            found[there, up, 0] = np.where(other[there] & 1, RIGHT, LEFT)
            found[there, up, 1:] = nodes[address(self.levels, depth, other[there])]
        return found


def siblings(path: bytes) -> list[tuple[int, bytes]]:
    return [(path[i], path[i + 1 : i + 1 + DIGEST]) for i in range(0, len(path), 1 + DIGEST)]


def folded(leaf: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for side, other in path:
        leaf = joined([leaf] if side == ALONE else [leaf, other] if side == RIGHT else [other, leaf])
    return leaf


# ---- tables


def leaf_hash(values: dict[str, Column]) -> Column:
    """The leaf of a row, binary: its values in order, each ``-`` or its bytes, a colon and itself."""

    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*(told(v) for v in values.values())).cast("binary"), 256))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their number ``pos`` within ``tree``, by ``order``, and the tree's ``total``.

    A row number makes the order total, so no range of the sort has to hold all of a key that repeats. A range's
    share of each tree starts where the shares before it end: one small row per range and tree.
    """
    rows = cut(rows, "rows").withColumn("row", F.monotonically_increasing_id())
    placed = rows.orderBy("tree", *order, "row").drop("row").withColumn("at", F.monotonically_increasing_id())
    placed = cut(placed, "sorted").withColumn("range", F.shiftright("at", _ROWS_PER_PARTITION_BITS))
    shares = placed.groupBy("tree", "range").agg(F.count("*").alias("n"), F.min("at").alias("low"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = shares.select(
        "tree", "range", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("base"), F.sum("n").over(tree).alias("total")
    )
    return placed.join(cut(starts, "starts"), ["tree", "range"]).withColumn("pos", F.col("at") + F.col("base")).drop("at", "base", "range")


def built(nodes: DataFrame, height: int) -> DataFrame:
    """The aligned subtrees over ``tree, pos, total, node``; ``total`` becomes the number of subtrees of the tree."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        total = table.column("total")[0].as_py()
        own = min(height, (total - 1).bit_length())
        subtree, root = Subtree.of(own, table.column("node").to_pylist())
        made = {
            "tree": table.column("tree")[0].as_py(), "block": table.column("block")[0].as_py(), "size": len(table),
            "height": own, "total": -(-total >> height), "nodes": bytes(subtree.nodes), "root": root,
        }
        return pa.Table.from_pylist([made], schema)

    schema = pa.schema([
        ("tree", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("height", pa.int32()), ("total", pa.int64()),
        ("nodes", pa.binary()), ("root", pa.binary()),
    ])
    placed = nodes.select("tree", "pos", "total", "node", F.shiftright("pos", height).alias("block"))
    kinds = "tree string, block bigint, size bigint, height int, total bigint, nodes binary, root binary"
    return placed.groupBy("tree", "block").applyInArrow(build, kinds)


def tiers(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The stored subtrees of all trees, tier by tier; there are four tiers up to 2 ** 48 leaves."""
    found = []
    while True:
        found.append(cut(built(nodes, height), "subtrees"))
        rest = found[-1].where("total > 1")
        if rest.isEmpty():
            return found
        nodes = rest.select("tree", F.col("block").alias("pos"), "total", F.col("root").alias("node"))


def roots(found: list[DataFrame]) -> DataFrame:
    every = [tier.where("total = 1").select("tree", "root") for tier in found]
    whole = every[0]
    for more in every[1:]:
        whole = whole.union(more)
    return whole


def with_paths(found: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """The subtrees of the lowest tier with the path of their roots; ``tops`` has ``tree, subroot, path``."""
    above = None
    for tier in reversed(found):
        now = tier.join(tops, "tree").where("total = 1")
        if above is not None:
            inner = tier.where("total > 1").join(tops.drop("path"), "tree").join(above, ["tree", "block"])
            now = now.unionByName(inner)
        if tier is found[0]:
            return now
        above = cut(_paths_below(now, height), "paths")


def _paths_below(subtrees: DataFrame, height: int) -> DataFrame:
    """``tree, block, path`` of every leaf of the given subtrees: those of the subtrees one tier below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                below = np.arange(row["size"])
                own = Subtree(row["height"], row["size"], row["nodes"]).paths(below)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * len(below), pa.string()),
                        pa.array(below + (row["block"] << height), pa.int64()),
                        pa.array([p.tobytes() + row["path"] for p in own], pa.binary()),
                    ],
                    names=["tree", "block", "path"],
                )

    kept = subtrees.select("tree", "block", "size", "height", "nodes", "path")
    return kept.mapInArrow(run, "tree string, block bigint, path binary")


@dataclass(frozen=True)
class Manifest:
    """Leaves ``tree, pos, total, doc_id, leaf`` and given columns, the stored subtrees, and the root of all."""

    leaves: DataFrame
    subtrees: list[DataFrame]
    tops: DataFrame
    root: bytes | None
    height: int


def manifest(docs: DataFrame, claimed: dict[str, Column] | None = None, height: int = HEIGHT) -> Manifest:
    """The manifest of ``docs``, a tree for each ``lang``.

    ``claimed`` replaces columns of some rows by what somebody claims they are: rows in which one of them is not
    null get the leaf of the claimed row, next to their own one.
    """
    own = {c: F.col(c) for c in COLUMNS}
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))  # the null tree comes first
    other = F.lit(None).cast("binary")
    if claimed:
        given = F.coalesce(*(c.cast("string") for c in claimed.values())).isNotNull()
        other = F.when(given, leaf_hash({c: F.coalesce(claimed[c].cast("string"), v.cast("string")) if c in claimed else v for c, v in own.items()}))
    rows = docs.select(
        tree.alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf_hash(own).alias("leaf"), other.alias("claimed")
    )
    leaves = cut(numbered(rows, ["doc_id", "leaf"]), "leaves")
    below = tiers(leaves.select("tree", "pos", "total", F.col("leaf").alias("node")), height)
    subroots = cut(roots(below), "subroots")
    ordered = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node")), ["name"])
    ordered = cut(ordered, "ordered")
    above = tiers(ordered.drop("name"), height)
    first = roots(above).first()
    whole = with_paths(above, _whole(above), height)
    named = _paths_below(whole, height).select(F.col("block").alias("pos"), "path").join(ordered.select("pos", F.col("name").alias("tree"), F.col("node").alias("subroot")), "pos")
    return Manifest(leaves, below, cut(named.select("tree", "subroot", "path"), "tops"), bytes(first.root) if first else None, height)


def _whole(above: list[DataFrame]) -> DataFrame:
    return roots(above).select("tree", F.col("root").alias("subroot"), F.lit(b"").alias("path"))


def proofs(made: Manifest) -> DataFrame:
    """Per leaf: ``doc_id, leaf, subroot, proof, folded``.

    ``proof`` has the digests of its siblings from its own level up to the root; ``folded`` is the root that the
    claimed leaf, or else the leaf, and these siblings lead to.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("leaf", pa.binary()), ("subroot", pa.binary()), ("proof", pa.binary()), ("folded", pa.binary()),
    ])
    height = made.height

    def prove(leaves: pa.Table, subtrees: pa.Table) -> pa.Table:
        row = subtrees.to_pylist()[0]
        numbers = leaves.column("pos").to_numpy() - (row["block"] << height)
        own = Subtree(row["height"], row["size"], row["nodes"]).paths(numbers)
        above = siblings(row["path"])
        found, ends = [], []
        pairs = zip(leaves.column("leaf").to_pylist(), leaves.column("claimed").to_pylist(), own)
        for leaf, claimed, path in pairs:
            whole = siblings(path.tobytes()) + above
            found.append(b"".join(other for side, other in whole if side != ALONE))
            ends.append(folded(leaf if claimed is None else claimed, whole))
        made = [leaves.column("doc_id"), leaves.column("leaf"), pa.array([row["subroot"]] * len(leaves), pa.binary()), found, ends]
        return pa.Table.from_arrays([c if isinstance(c, pa.ChunkedArray) else pa.array(c, pa.binary()) for c in made], schema=schema)

    placed = made.leaves.withColumn("block", F.shiftright("pos", height))
    stored = with_paths(made.subtrees, made.tops, height).select("tree", "block", "size", "height", "nodes", "subroot", "path")
    kinds = "doc_id bigint, leaf binary, subroot binary, proof binary, folded binary"
    return placed.groupBy("tree", "block").cogroup(stored.groupBy("tree", "block")).applyInArrow(prove, kinds)
