"""Merkle manifest of a dataset, kept as append logs in postorder.

Leaves of a group (a source) ascend by an order; while there are several nodes, every
WAYS consecutive ones become the digest of their digests, the last run having fewer. What
remains of each group is a leaf of the tree over the groups.

A builder is a task that holds one aligned block of WAYS ** LEVELS leaves. It appends each
node when its last leaf is there, children before parents, so its log is the postorder of
the block's tree. Nothing points to anything: the node at level l whose last leaf is e
stands behind e leaves, e // WAYS nodes of level 1, ..., and the l nodes that end with it,
so its position is l + e + e // WAYS + e // WAYS ** 2 + ... . A node's siblings end where
the subtrees beside it end, whose sizes are known, and are read from there for a proof.

Blocks' last nodes are the leaves of the next tier, in blocks of their own, until each
group has one node; a billion rows are three tiers. So no task holds more than a block,
and one group with a third of all rows is as many tasks as any other rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

#: Children of a node.
WAYS = 3
#: Levels above the leaves in a builder's block.
LEVELS = 7
#: Bytes of a digest in a log.
DIGEST = 32

KEY = ["m_group", "m_block"]
SIBLINGS = T.ArrayType(T.StructType().add("before", T.StringType()).add("after", T.StringType()))


def digest_of(columns: list[Column]) -> Column:
    """Lowercase hex sha256 of the values: ``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def height(leaves: int) -> int:
    """Levels above the leaves of a whole tree."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // WAYS), levels + 1
    return levels


def subtree_size(level: int, leaves: int) -> int:
    """Nodes of a subtree of that level over so many leaves; a last subtree may have fewer than it has room for."""
    return sum(-(-leaves // WAYS**at) for at in range(level + 1))


def position(level: int, last: np.ndarray) -> np.ndarray:
    """Where the nodes of a level stand in the log, by their last leaf: behind what was complete before it."""
    last = np.asarray(last, np.int64)
    found, left = last + level, last // WAYS
    while left.any():
        found, left = found + left, left // WAYS
    return found


def append_log(leaves: list[bytes], levels: int) -> bytes:
    """All nodes of a block's tree, raw digests, in the order in which they are complete."""
    log: list[bytes] = []
    open_nodes: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def append(node: bytes, level: int) -> None:
        log.append(node)
        open_nodes[level].append(node)

    def close(level: int) -> None:
        children = b"".join(open_nodes[level]).hex().encode()
        open_nodes[level] = []
        append(hashlib.sha256(children).digest(), level + 1)

    for leaf in leaves:
        append(leaf, 0)
        level = 0
        while level < levels and len(open_nodes[level]) == WAYS:
            close(level)
            level += 1
    for level in range(levels):
        if open_nodes[level]:
            close(level)
    return b"".join(log)


def siblings(log: bytes, slots: np.ndarray, leaves: int, levels: int) -> list[list[dict[str, str]]]:
    """For each slot and level the digests before and after the node on its path, in hex, read by position."""
    found: list[list[dict[str, str]]] = [[] for _ in slots]
    for level in range(levels):
        width, nodes = WAYS**level, -(-leaves // WAYS**level)
        node = slots // width
        first = node - node % WAYS
        texts = []
        for step in range(WAYS):
            other = first + step
            there = other < nodes
            at = position(level, np.minimum((other + 1) * width, leaves) - 1) * DIGEST
            texts.append([log[a : a + DIGEST].hex() if yes else "" for a, yes in zip(at.tolist(), there.tolist())])
        for row, own in enumerate((node - first).tolist()):
            found[row].append(
                {"before": "".join(texts[s][row] for s in range(own)), "after": "".join(texts[s][row] for s in range(own + 1, WAYS))}
            )
    return found


def _levels(size: int, block: int) -> int:
    """Levels of a block's tree: all, unless the block is the whole group."""
    return height(min(size, block))


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    return rows.withColumns({"m_block": F.expr(f"m_at div {block}"), "m_slot": (F.col("m_at") % block).cast("int")})


def _build(rows: DataFrame, block: int) -> DataFrame:
    """A builder per block: m_group, m_block, m_size (leaves of the group), m_log and m_root."""

    def build(key: tuple, part: pa.Table) -> pa.Table:
        slots = part["m_slot"].to_numpy()
        order, size = np.argsort(slots), part["m_size"][0].as_py()
        leaves = [bytes.fromhex(digest) for digest in part["m_digest"].take(order).to_pylist()]
        log = append_log(leaves, _levels(size, block))
        return pa.table(
            {
                "m_group": pa.array([key[0].as_py()], pa.string()),
                "m_block": pa.array([key[1].as_py()], pa.int64()),
                "m_size": pa.array([size], pa.int64()),
                "m_log": pa.array([log], pa.binary()),
                "m_root": [log[-DIGEST:].hex()],
            }
        )

    picked = _blocks(rows, block).select(*KEY, "m_slot", "m_digest", "m_size")
    return picked.groupBy(*KEY).applyInArrow(
        build, "m_group string, m_block long, m_size long, m_log binary, m_root string"
    )


def _prove(rows: DataFrame, logs: DataFrame, block: int) -> DataFrame:
    """Rows with m_path, m_subroot and m_top; ``logs`` has those of the blocks as m_above, m_subroot and m_top."""
    rows = _blocks(rows, block)
    schema = T.StructType(list(rows.schema)).add("m_path", SIBLINGS).add("m_subroot", "string").add("m_top", "string")
    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

    def prove(key: tuple, part: pa.Table, of_block: pa.Table) -> pa.Table:
        if not part.num_rows:
            return _with(part, [], [], [])
        known = of_block.slice(0, 1).to_pylist()[0]
        size, number = known["m_size"], key[1].as_py()
        leaves = min(block, size - number * block)
        paths = siblings(known["m_log"], part["m_slot"].to_numpy().astype(np.int64), leaves, _levels(size, block))
        n = part.num_rows
        return _with(part, [path + known["m_above"] for path in paths], [known["m_subroot"]] * n, [known["m_top"]] * n)

    def _with(part: pa.Table, paths: list, subroots: list, tops: list) -> pa.Table:
        part = part.append_column("m_path", pa.array(paths, kind))
        part = part.append_column("m_subroot", pa.array(subroots, pa.string()))
        return part.append_column("m_top", pa.array(tops, pa.string()))

    return rows.groupBy(*KEY).cogroup(logs.groupBy(*KEY)).applyInArrow(prove, schema).drop("m_block", "m_slot")


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add m_at, the gapless place within m_group by ``order``, and m_size, the rows of the group.

    Ranges of (group, order) are dealt to partitions and kept; a group that spans many partitions is numbered
    in each, behind the rows of the partitions before.
    """
    ranges = cut(rows.repartitionByRange("m_group", *order).withColumn("m_part", F.spark_partition_id()))
    counts = ranges.groupBy("m_group", "m_part").agg(F.count("*").alias("m_rows"))
    whole = Window.partitionBy("m_group")
    starts = counts.select(
        F.col("m_group").alias("m_of"),
        F.col("m_part").alias("m_in"),
        (F.sum("m_rows").over(whole.orderBy("m_part")) - F.col("m_rows")).alias("m_start"),
        F.sum("m_rows").over(whole).alias("m_size"),
    )
    within = F.row_number().over(Window.partitionBy("m_group", "m_part").orderBy(*order)) - 1
    joined = ranges.withColumn("m_within", within).join(
        starts, (F.col("m_group") == F.col("m_of")) & (F.col("m_part") == F.col("m_in"))
    )
    return joined.withColumn("m_at", (F.col("m_start") + F.col("m_within")).cast("long")).drop(
        "m_part", "m_within", "m_of", "m_in", "m_start"
    )


@dataclass(frozen=True)
class Tree:
    """Tiers from the leaves up: the rows of each and their builders' logs."""

    rows: list[DataFrame]
    logs: list[DataFrame]
    block: int

    def roots(self) -> DataFrame:
        """m_group, m_root: what remains of each group, from the tier at which it is one block."""
        found = None
        for logs in self.logs:
            done = logs.filter(F.col("m_size") <= self.block).select("m_group", "m_root")
            found = done if found is None else found.unionByName(done)
        return found

    def paths(self, above: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
        """The rows of the first tier with m_path, m_subroot and m_top.

        ``above`` has, per group, m_above (the path above the group's root), m_subroot and m_top. ``wanted``
        are the rows to prove, all by default.
        """
        found = None
        for rows, logs in reversed(list(zip(self.rows, self.logs))):
            ended = logs.filter(F.col("m_size") <= self.block).join(above, "m_group")
            if found is not None:
                higher = found.select(
                    "m_group", F.col("m_at").alias("m_block"), F.col("m_path").alias("m_above"), "m_subroot", "m_top"
                )
                ended = ended.unionByName(logs.join(higher, KEY))
            found = _prove(wanted if wanted is not None and rows is self.rows[0] else rows, ended, self.block)
        return found


def grow(leaves: DataFrame, order: list[str], levels: int = LEVELS) -> Tree:
    """The tree over rows of m_group (string, not null), m_digest (hex) and the columns of ``order``."""
    block = WAYS**levels
    rows, logs = [cut(_placed(leaves, order))], []
    while True:
        logs.append(cut(_build(rows[-1], block)))
        above = logs[-1].filter(F.col("m_size") > block)
        if above.isEmpty():
            return Tree(rows, logs, block)
        rows.append(
            above.select(
                "m_group",
                F.col("m_root").alias("m_digest"),
                F.expr(f"(m_size + {block - 1}) div {block}").alias("m_size"),
                F.col("m_block").alias("m_at"),
            )
        )


@dataclass(frozen=True)
class Manifest:
    """The trees of the groups, and the tree over their roots."""

    groups: Tree
    top: Tree

    def root(self) -> DataFrame:
        """One row with m_root; none for an empty dataset."""
        return self.top.roots().select("m_root")

    def log(self) -> DataFrame:
        """The manifest to store: part ('groups' or 'top'), tier, m_group, m_block, m_size, m_log and m_root."""
        parts = [("groups", tier, logs) for tier, logs in enumerate(self.groups.logs)]
        parts += [("top", tier, logs) for tier, logs in enumerate(self.top.logs)]
        found = None
        for part, tier, logs in parts:
            named = logs.select(F.lit(part).alias("part"), F.lit(tier).alias("tier"), "*")
            found = named if found is None else found.unionByName(named)
        return found

    def proofs(self, wanted: DataFrame | None = None) -> DataFrame:
        """The leaves' columns with siblings (before and after the node, per level), subroot and root.

        ``wanted`` are rows of ``leaves()`` to prove; only their blocks' logs are read then.
        """
        nothing = F.array().cast(SIBLINGS)
        ends = self.top.roots()
        over_top = ends.select("m_group", nothing.alias("m_above"), F.col("m_root").alias("m_subroot"), F.col("m_root").alias("m_top"))
        of_groups = self.top.paths(over_top).select(
            F.col("m_name").alias("m_group"), F.col("m_path").alias("m_above"), F.col("m_digest").alias("m_subroot"), "m_top"
        )
        found = self.groups.paths(of_groups, wanted)
        return found.withColumnsRenamed({"m_path": "siblings", "m_subroot": "subroot", "m_top": "root", "m_digest": "leaf"}).drop(
            "m_group", "m_size", "m_at"
        )

    def leaves(self) -> DataFrame:
        """The rows that were given, with their place (m_at) in their group."""
        return self.groups.rows[0]


def manifest(leaves: DataFrame, group: str, order: str, digest: str, levels: int = LEVELS) -> Manifest:
    """The manifest of rows with a digest (hex) each.

    Groups are ordered by ``group`` as text, null first, by UTF-8 bytes; a group's leaves by ``order``, null first,
    then by digest, so that rows with one number have a place as well. Further columns are carried along to the
    proofs; names that start with ``m_`` are refused. An empty table gives no root and no proofs.
    """
    taken = [name for name in leaves.columns if name.startswith("m_")]
    if taken:
        raise ValueError(f"column name(s) {taken} start with m_")
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    given = leaves.withColumns({"m_group": name, "m_digest": F.col(digest)}).drop(digest)
    # digests are kept before they are put in order, which looks at the rows twice
    groups = grow(cut(given), [order, "m_digest"], levels)
    roots = groups.roots().select(F.lit("").alias("m_group"), F.col("m_root").alias("m_digest"), F.col("m_group").alias("m_name"))
    return Manifest(groups, grow(roots, ["m_name"], levels))


def proof_digest(path: Column) -> Column:
    """Lowercase hex sha256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))
