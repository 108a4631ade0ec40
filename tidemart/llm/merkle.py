"""Merkle manifest of a dataset: a tree per group, a tree over the groups, and a witness for each row.

A row's leaf is the SHA-256 of its fields. Within a group the leaves ascend; while several nodes
remain, every two that follow each other become the digest of both, and a last one alone becomes
the digest of itself. The groups' roots, in the order of the groups, are the leaves of one more tree.

Witnesses grow incrementally. A task appends the leaves of an aligned block of ``2 ** LEVELS`` one
by one to a stack of open subtrees, each of which carries the partial witnesses of its leaves; as a
sibling completes, the witnesses on both sides gain the other's digest and the two become one open
subtree. The block's root is then a leaf of the next tier, where the same is done with the roots of
as many blocks, appended by other tasks, and so on until a group has one node. A row's witness is
its block's part, followed by the parts of the tiers above. ``append`` takes up a manifest again:
closed blocks stay as they are, only the open block of a group is appended to.

How it runs: rows are sorted by (group, order) in a range partitioning, so that a large group lies in
many tasks; a row's place is its number within the partition, shifted by a count per partition.
Blocks are dealt by hash, 1,024 rows each, whatever the group's size. A task holds one block. Each
tier has a thousandth of the rows of the one below, and the number of tiers follows from one counted
number; nothing else reaches the driver.

A witness is an array of steps from the leaf up: ``L`` or ``R`` and the sibling's digest, by the side
on which the sibling stands, or ``-`` where a node stood alone. ``fold`` recomputes the root from it.

Defined results: a null field is written ``-``, others as byte count, colon, value; a null group is a
group of its own and comes first. Rows without an order value come first in their group; equal ones
stand by leaf, and wholly equal rows each have a place. Empty texts are values, texts of any length
are hashed whole. An empty table has no rows in its manifest and no root. Only the named columns are
read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import Workspace, small_side

# Levels of a block: a task holds the witnesses of 2 ** LEVELS rows.
LEVELS = 10
# Rows of a witness side (up to a few kilobytes each) that may be sent to all executors.
SMALL_ROWS = 10_000


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field as it enters a leaf: ``-`` for null, else its length in bytes, a colon, and itself."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*fields: Column) -> Column:
    return digest(*(field(x) for x in fields))


def fold(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    def step(node: Column, at: Column) -> Column:
        other = F.substring(at, 2, 64)
        return F.sha2(F.when(at.startswith("L"), F.concat(other, node)).otherwise(F.concat(node, other)), 256)
    return F.aggregate(witness, leaf, step)


def siblings(witness: Column) -> Column:
    """The digests of a witness, from the leaf up, one after another."""
    return F.array_join(F.transform(witness, lambda x: F.substring(x, 2, 64)), "")


def _both(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class OpenSubtrees:
    """Subtrees that still wait for a sibling, tallest first, with the witnesses of their leaves."""

    def __init__(self):
        self._open: list[tuple[int, str, list[list[str]]]] = []

    def append(self, leaf: str, witness: list[str]) -> None:
        """Add a leaf on the right; its ``witness`` is extended in place from now on."""
        self._push(0, leaf, [witness])

    def _push(self, height: int, root: str, witnesses: list[list[str]]) -> None:
        while self._open and self._open[-1][0] == height:
            _, left, before = self._open.pop()
            for witness in before:
                witness.append("R" + root)
            for witness in witnesses:
                witness.append("L" + left)
            before.extend(witnesses)
            height, root, witnesses = height + 1, _both(left, root), before
        self._open.append((height, root, witnesses))

    def close(self, height: int) -> str:
        """Raise what stands alone until one tree of at least ``height`` is left; gives its root."""
        while len(self._open) > 1 or self._open[0][0] < height:
            lone, root, witnesses = self._open.pop()
            for witness in witnesses:
                witness.append("-")
            self._push(lone + 1, _both(root), witnesses)
        return self._open[0][1]


def _grown(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """Add the witness within the block, and to a block's first row the block's root.

    Rows come sorted by tree and place; further columns pass through.
    """
    block, held = None, []

    def closed() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        subtrees, witnesses = OpenSubtrees(), [[] for _ in range(rows.num_rows)]
        for leaf, witness in zip(rows.column("digest").to_pylist(), witnesses, strict=True):
            subtrees.append(leaf, witness)
        several = rows.column("n")[0].as_py() > 2 ** levels
        root = subtrees.close(levels if several else 0)
        return (rows.append_column("witness", pa.array(witnesses, pa.list_(pa.string())))
                .append_column("block_root", pa.array([root] + [None] * (rows.num_rows - 1), pa.string())))

    for batch in batches:
        places = batch.column("place").to_pylist()
        blocks = [(tree, at >> levels) for tree, at in zip(batch.column("tree").to_pylist(), places, strict=True)]
        start = 0
        for i, at in enumerate(blocks):
            if at != block:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield closed()
                block, held, start = at, [], i
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield closed()


def _with_witness(nodes: DataFrame, levels: int) -> DataFrame:
    """Append the nodes (tree, place, n, digest, ...) block by block."""
    schema = T.StructType([*nodes.schema.fields, T.StructField("witness", T.ArrayType(T.StringType())),
                           T.StructField("block_root", T.StringType())])
    return (nodes.repartition("tree", F.shiftright("place", levels)).sortWithinPartitions("tree", "place")
            .mapInArrow(lambda x: _grown(x, levels), schema))


def place(rows: DataFrame, order: list[str], work: Workspace, name: str) -> DataFrame:
    """Add each row's ``place`` within its tree, from 0, and the tree's ``n``.

    ``rows`` is a written table. The sort is a range partitioning; counts per partition and
    tree shift the numbers of its rows.
    """
    keys = ["tree", *order]
    numbered = work.save(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("at", F.monotonically_increasing_id()), f"{name}-sorted")
    part = F.shiftright("at", 33).alias("part")
    runs = numbered.groupBy("tree", part).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = work.save(runs.select("tree", "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
                                 F.sum("rows").over(Window.partitionBy("tree")).alias("n")), f"{name}-runs")
    shifted = (F.col("at") - F.col("first") + F.col("before")).alias("place")
    return (numbered.withColumn("part", part).join(small_side(runs), ["tree", "part"])
            .select(*(c for c in rows.columns), shifted, "n"))


def _tiers(nodes: DataFrame, levels: int, work: Workspace, name: str, ready: DataFrame | None = None) -> list[DataFrame]:
    """The written tiers of trees, each with its witnesses; the last has one block per tree."""
    grown = _with_witness(nodes, levels)
    tiers = [work.save(grown if ready is None else grown.unionByName(ready.select(*grown.columns)), f"{name}-0")]
    while (tiers[-1].agg(F.max("n")).first()[0] or 0) > 2 ** levels:
        # Trees that ended below have one node here, whose witness is empty.
        up = tiers[-1].where("block_root IS NOT NULL").select(
            "tree", F.shiftright("place", levels).alias("place"), F.shiftright(F.col("n") + (2 ** levels - 1), levels).alias("n"),
            F.col("block_root").alias("digest"))
        tiers.append(work.save(_with_witness(up, levels), f"{name}-{len(tiers)}"))
    return tiers


def _roots(tiers: list[DataFrame]) -> DataFrame:
    return tiers[-1].where("block_root IS NOT NULL").select("tree", F.col("block_root").alias("root"))


def _extended(tiers: list[DataFrame], levels: int, trees: DataFrame, work: Workspace, name: str) -> DataFrame:
    """The lowest tier's rows with whole witnesses: each tier's part, then the tree's own.

    ``trees`` has ``tree``, ``upper`` (the steps above the tree's root) and further columns for each tree.
    """
    side, keys = work.save(trees, f"{name}-trees"), ["tree"]
    given = [c for c in trees.columns if c not in ("tree", "upper")]
    for at in range(len(tiers) - 1, -1, -1):
        here = tiers[at].drop("n", "block_root").withColumn("block", F.shiftright("place", levels))
        joined = here.join(small_side(side, SMALL_ROWS), keys).withColumn("witness", F.concat("witness", "upper")).drop("block", "upper")
        if at == 0:
            return joined
        side = work.save(joined.select("tree", F.col("place").alias("block"), F.col("witness").alias("upper"), *given), f"{name}-above-{at}")
        keys = ["tree", "block"]


def tree_key(group: Column) -> Column:
    """Groups as tree names: null first, the others by bytes."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


class Manifest:
    """A dataset's trees.

    ``rows`` has ``leaf``, ``subroot``, ``root`` and ``witness`` for each row, its ``place`` in its group, and a
    struct ``kept`` with the order, the group and what else was carried. ``tiers`` are the groups' tiers.
    """

    def __init__(self, nodes: DataFrame, levels: int, work: Workspace, ready: DataFrame | None = None):
        self.levels = levels
        self.tiers = _tiers(nodes, levels, work, "groups", ready)
        tops = work.save(_roots(self.tiers).select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("root").alias("digest")), "tops")
        over = _tiers(place(tops, ["group"], work, "tops"), levels, work, "top")
        trees = _extended(over, levels, _roots(over).withColumn("upper", F.array().cast("array<string>")), work, "top").select(
            F.col("group").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("witness").alias("upper"))
        self.rows = _extended(self.tiers, levels, trees, work, "groups").drop("tree").withColumnRenamed("digest", "leaf")


def _leaves(docs: DataFrame, fields: list[str], group: str, order: str, carry: dict[str, Column]) -> DataFrame:
    kept = {order: F.col(f"`{order}`"), group: F.col(f"`{group}`"), **carry}
    return docs.select(tree_key(F.col(f"`{group}`")).alias("tree"), F.col(f"`{order}`").alias("order"),
                       leaf_of(*(F.col(f"`{c}`") for c in fields)).alias("digest"),
                       F.struct(*(x.alias(c) for c, x in kept.items())).alias("kept"),
                       F.monotonically_increasing_id().alias("row"))


def build(docs: DataFrame, fields: list[str], group: str, order: str, work: Workspace,
          carry: dict[str, Column] | None = None, levels: int = LEVELS) -> Manifest:
    """The manifest of a table: leaves of ``fields``, a tree per ``group`` with its leaves by ``order``.

    ``carry`` names further narrow columns to keep for each row.
    """
    leaves = work.save(_leaves(docs, fields, group, order, carry or {}), "leaves")
    # Wholly equal rows are told apart by number, so that many of them can lie in many tasks.
    placed = place(leaves, ["order", "digest", "row"], work, "leaves").drop("row")
    return Manifest(placed, levels, work)


def append(manifest: Manifest, docs: DataFrame, fields: list[str], group: str, order: str, work: Workspace,
           carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of the earlier rows and ``docs``, whose order values must not precede their group's earlier ones.

    Blocks that are full, and groups without new rows, keep the witnesses they have within the block.
    ``work`` is a new folder; columns and arguments are those of ``build``.
    """
    before = manifest.tiers[0]
    leaves = work.save(_leaves(docs, fields, group, order, carry or {}), "leaves")
    ends = before.groupBy("tree").agg(F.first("n").alias("old"), F.max("order").alias("last"))
    starts = leaves.groupBy("tree").agg(F.min("order").alias("least"), F.count("*").alias("new"),
                                        F.count_if(F.col("order").isNull()).alias("nulls"))
    sizes = work.save(ends.join(starts, "tree", "full").select(
        "tree", F.coalesce("old", F.lit(0)).alias("old"), F.coalesce("new", F.lit(0)).alias("new"),
        F.coalesce((F.col("least") < F.col("last")) | ((F.col("nulls") > 0) & F.col("last").isNotNull()), F.lit(False)).alias("late")), "sizes")
    if not sizes.where("late").isEmpty():
        raise ValueError("rows to append must not precede the rows of their group")
    sizes, n = small_side(sizes), (F.col("old") + F.col("new")).alias("n")
    added = (place(leaves, ["order", "digest", "row"], work, "leaves").drop("row", "n").join(sizes, "tree")
             .withColumn("place", F.col("place") + F.col("old")))
    earlier = before.drop("n").join(sizes, "tree")
    is_open = (F.col("new") > 0) & (F.shiftright("place", manifest.levels) == F.shiftright("old", manifest.levels))
    columns = [c for c in before.columns if c not in ("n", "witness", "block_root")]
    nodes = (earlier.where(is_open).select(*columns, n).unionByName(added.select(*columns, n)))
    ready = earlier.where(~is_open).select(*columns, n, "witness", "block_root")
    return Manifest(nodes, manifest.levels, work, ready)
