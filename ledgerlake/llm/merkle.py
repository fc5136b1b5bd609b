"""Merkle manifest of a dataset: a tree for each source, a tree over the sources, and a witness for every row.

Rows are put in order and cut into aligned blocks of 3 ** LEVELS leaves. Inside a task a block's leaves are appended one
by one to a growing tree: what is known of a witness hangs on the open subtrees, and each sibling that completes a run
extends it for all leaves below at once. The blocks' roots are appended in the same way, block by block, until a tree has
one node; then witnesses are handed down again. So no task sees more than a block, and the rounds are few.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ship, written

#: Nodes of a run that become one node of the level above; levels of a block.
ARITY, LEVELS = 3, 5
BLOCK = ARITY**LEVELS


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def fold(leaf: str, left: list[str], right: list[str]) -> str:
    """The root that a leaf and its witness lead to."""
    for a, b in zip(left, right):
        leaf = digest(a, leaf, b)
    return leaf


class _Node:
    """A subtree: its digest, and once its run is complete the siblings to its left and right and the subtree above."""

    __slots__ = ("above", "digest", "left", "right")

    def __init__(self, text: str):
        self.digest, self.left, self.right, self.above = text, "", "", None


class GrowingTree:
    """A tree to which nodes are appended from left to right."""

    def __init__(self) -> None:
        self.nodes: list[_Node] = []
        self.open: list[list[_Node]] = [[]]

    def append(self, text: str) -> None:
        node, level = _Node(text), 0
        self.nodes.append(node)
        self.open[0].append(node)
        while len(self.open[level]) == ARITY:
            self._complete(level)
            level += 1

    def _complete(self, level: int) -> None:
        """The open run becomes a node of the level above; its members' witnesses grow by one step."""
        run, self.open[level] = self.open[level], []
        above = _Node(digest(*(n.digest for n in run)))
        for k, node in enumerate(run):
            node.left = "".join(n.digest for n in run[:k])
            node.right = "".join(n.digest for n in run[k + 1 :])
            node.above = above
        if level + 1 == len(self.open):
            self.open.append([])
        self.open[level + 1].append(above)

    def close(self, height: int | None = None) -> str:
        """Completes all open runs, up to `height` levels or, if None, until one node is left; the digest of that."""
        level = 0
        while level != height if height is not None else level + 1 < len(self.open) or len(self.open[level]) > 1:
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.open[level][0].digest

    def witness(self, at: int) -> tuple[list[str], list[str]]:
        """Siblings to the left and right of each node from leaf `at` upwards."""
        left, right, node = [], [], self.nodes[at]
        while node.above is not None:
            left.append(node.left)
            right.append(node.right)
            node = node.above
        return left, right


def _grown(digests: pa.Array, n: int) -> tuple[GrowingTree, str]:
    """The tree of one block of a tree with n nodes, and the block's root."""
    tree = GrowingTree()
    for value in digests.to_pylist():
        tree.append(value.hex())
    return tree, tree.close(LEVELS if n > BLOCK else None)


# ---- order and blocks -----------------------------------------------------------------------------------------------


def _placed(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """rows with pos, a gapless number from 0 in the order within `tree`, and n, the tree's rows; sorted in ranges."""
    rows = rows.withColumn("_row", F.monotonically_increasing_id())  # equal rows are dealt to several ranges
    keys = ["tree", *order, "_row"]
    rows = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33).alias("_part")
    tree = Window.partitionBy("tree")  # a row for each range that the tree has rows in
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("tree", part).agg(F.count("*").alias("_n"), F.min("_at").alias("_first")).select(
        "tree", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_move"), F.sum("_n").over(tree).alias("n")
    )
    return (
        rows.withColumn("_part", F.shiftright("_at", 33)).join(written(starts, "merkle-starts"), ["tree", "_part"])
        .withColumn("pos", F.col("_at") + F.col("_move")).drop("_row", "_at", "_part", "_move")
    )


def _blocks(placed: DataFrame, label: str) -> DataFrame:
    """A row for each block: tree, block, n and its nodes in order."""
    rest = [c for c in placed.columns if c not in ("tree", "n", "pos")]
    grouped = placed.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block"), "n")
    return written(grouped.agg(F.sort_array(F.collect_list(F.struct("pos", *rest))).alias("nodes")), label)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tree, block, n, root) of whole blocks."""
    for batch in batches:
        sizes, digests = batch.column("n").to_pylist(), batch.column("digests")
        roots = [bytes.fromhex(_grown(digests[k].values, n)[1]) for k, n in enumerate(sizes)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("tree"), batch.column("block"), batch.column("n"), pa.array(roots, pa.binary())], names=["tree", "block", "n", "root"]
        )


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tree, block, left, right, root) of every node of whole blocks, with what lies above them."""
    for batch in batches:
        rows = {name: [] for name in ("tree", "block", "left", "right", "root")}
        for row in batch.to_pylist():
            tree, _ = _grown(pa.array(row["digests"], pa.binary()), row["n"])
            for k in range(len(tree.nodes)):
                left, right = tree.witness(k)
                rows["tree"].append(row["tree"])
                rows["block"].append(row["block"] * BLOCK + k)
                rows["left"].append(left + row["left"])
                rows["right"].append(right + row["right"])
                rows["root"].append(row["root"])
        kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=list(rows))


_ABOVE = "tree string, block long, left array<string>, right array<string>, root binary"


def _above(blocks: DataFrame) -> DataFrame:
    """For each block (tree, block, n, nodes with a digest): left and right, its witness within its tree, and the tree's root."""
    roots = blocks.select("tree", "block", "n", F.col("nodes.digest").alias("digests")).mapInArrow(_roots, "tree string, block long, n long, root binary")
    roots = written(roots, "merkle-roots")
    none = F.array().cast("array<string>")
    done = roots.filter(F.col("n") <= BLOCK).select("tree", "block", none.alias("left"), none.alias("right"), "root")
    more = roots.filter(F.col("n") > BLOCK)
    if more.isEmpty():
        return done
    nodes = more.select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("root").alias("digest"))
    upper = _blocks(nodes, "merkle-upper")
    held = upper.select("tree", "block", "n", F.col("nodes.digest").alias("digests")).join(_above(upper), ["tree", "block"])
    return written(done.union(held.mapInArrow(_paths, _ABOVE)), "merkle-above")


# ---- rows -----------------------------------------------------------------------------------------------------------


def leaf(*columns: Column) -> Column:
    """Hex digest of a row: each column `-` if null, else its length in bytes, a colon and its text."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, columns)), 256)


_NAMES = ["leaf", "subroot", "root", "left", "right", "proof_sha256", "folded_root", "verified"]


def merkle_manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    tree_col: str = "source",
    id_col: str = "doc_id",
    now: dict[str, Column] | None = None,
    witnesses: bool = False,
) -> DataFrame:
    """id_col, leaf, subroot, root, proof_sha256, folded_root and verified of every row; with `witnesses` left and right as well.

    A leaf is the digest of `columns`. Leaves of one value of `tree_col` ascend by id
    (null first; equal ids by leaf) and form a tree of runs of three, the last one shorter; its
    root is subroot. Subroots, null first and then by UTF-8 bytes, form the tree of
    root. left and right hold the siblings of each node from the leaf to the root,
    proof_sha256 is the digest of all of them. `now` gives columns as they are found
    today: folded_root is what today's leaf and the siblings lead to, verified whether that
    is root.

    A null, an empty and a missing value are told apart in a leaf. Equal rows are leaves of
    their own. A tree of one leaf has that as its root. An empty table gives
    no rows. Texts may be of any length: they are hashed where they are read, and only
    digests move. Other columns are not read.
    """
    ship(docs.sparkSession)
    source = F.col(tree_col).cast("string")
    tree = F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))
    original, today = leaf(*map(F.col, columns)), leaf(*((now or {}).get(c, F.col(c)) for c in columns))
    rows = docs.select(tree.alias("tree"), F.col(id_col).alias("id"), F.unhex(original).alias("digest"), F.unhex(today).alias("today"))
    rows = rows.withColumn("today", F.nullif("today", "digest"))  # null: as it was
    blocks = _blocks(_placed(rows, ["id", "digest"], "merkle-rows"), "merkle-blocks")
    above = _above(blocks)
    # the trees' roots are leaves of the last tree
    trees = above.filter("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("root").alias("digest"))
    last = _blocks(_placed(trees, ["id"], "merkle-trees"), "merkle-last")
    held = last.select("tree", "block", "n", F.col("nodes.digest").alias("digests")).join(_above(last), ["tree", "block"])
    places = last.select(F.explode("nodes").alias("x")).select(F.col("x.pos").alias("block"), F.col("x.id").alias("tree"))
    tops = held.mapInArrow(_paths, _ABOVE).drop("tree").join(places, "block").select(
        "tree", F.col("left").alias("top_left"), F.col("right").alias("top_right"), F.col("root").alias("top")
    )
    above = above.join(written(tops, "merkle-tops"), "tree").select(
        "tree", "block", F.concat("left", "top_left").alias("left"), F.concat("right", "top_right").alias("right"), F.col("root").alias("subroot"), "top"
    )

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                nodes = row["nodes"].values
                tree, _ = _grown(nodes.field("digest"), row["n"].as_py())
                upper_left, upper_right = row["left"].as_py(), row["right"].as_py()
                subroot, top = row["subroot"].as_py().hex(), row["top"].as_py().hex()
                lefts, rights, proofs, folded = [], [], [], []
                for at, today in enumerate(nodes.field("today").to_pylist()):
                    left, right = tree.witness(at)
                    left, right = left + upper_left, right + upper_right
                    proofs.append(digest(*(x for pair in zip(left, right) for x in pair)))
                    folded.append(fold(tree.nodes[at].digest if today is None else today.hex(), left, right))
                    if witnesses:
                        lefts.append(left)
                        rights.append(right)
                n = len(folded)
                shown = {
                    "leaf": pa.array([x.digest for x in tree.nodes], pa.string()), "subroot": pa.array([subroot] * n, pa.string()),
                    "root": pa.array([top] * n, pa.string()), "left": pa.array(lefts, pa.list_(pa.string())),
                    "right": pa.array(rights, pa.list_(pa.string())), "proof_sha256": pa.array(proofs, pa.string()),
                    "folded_root": pa.array(folded, pa.string()), "verified": pa.array([x == top for x in folded], pa.bool_()),
                }
                yield pa.RecordBatch.from_arrays([nodes.field("id"), *(shown[c] for c in names)], names=[id_col, *names])

    names = [c for c in _NAMES if witnesses or c not in ("left", "right")]
    kinds = {"left": "array<string>", "right": "array<string>", "verified": "boolean"}
    schema = ", ".join([f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}", *(f"{c} {kinds.get(c, 'string')}" for c in names)])
    return blocks.join(above, ["tree", "block"]).mapInArrow(prove, schema)
