"""Connected components by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few edges as join what the given ones join: every node but the smallest, with the smallest."""
    nodes, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = place[: len(left)], place[len(left) :]
    label = np.arange(len(nodes))
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            break
        np.minimum.at(label, high[apart], low[apart])
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[child]], nodes[child]


#: Edges that one task contracts before the stars begin.
EDGES_PER_TASK = 1 << 20


def _contracted(edges: DataFrame) -> DataFrame:
    """The edges of each partition as a forest, which joins the same nodes with fewer rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.empty(0, np.int64), np.empty(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if sum(len(part) for part, _ in held) > max(len(low), 1 << 17):
                low, high = forest(np.concatenate([low, *(a for a, _ in held)]), np.concatenate([high, *(b for _, b in held)]))
                held = []
        low, high = forest(np.concatenate([low, *(a for a, _ in held)]), np.concatenate([high, *(b for _, b in held)]))
        yield pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["low", "high"])

    return edges.select("low", "high").mapInArrow(run, "low long, high long")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node of the edges (low, high; longs) but the roots.

    Large and small stars in turn until nothing changes. A node's neighbours are never gathered, only
    their minimum is taken, so a node may have any number of them.
    """
    ordered = edges.select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")).where("low < high")
    current = cut(_contracted(ordered))
    # once more over as few partitions as the edges that are left allow
    current = cut(_contracted(current.repartition(-(-current.count() // EDGES_PER_TASK) or 1, "high")).distinct())
    while True:
        # large star: every larger neighbour of a node goes to the node's smallest neighbour or itself
        both = current.unionByName(current.select(F.col("high").alias("low"), F.col("low").alias("high")))
        least = both.groupBy(F.col("low").alias("node")).agg(F.least(F.min("high"), F.first("low")).alias("root"))
        large = both.join(least, F.col("low") == F.col("node")).where("high > low").select(F.col("root").alias("low"), "high")
        # small star: a node and its smaller neighbours go to the smallest of them
        lowest = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root"))
        joined = large.join(lowest, F.col("high") == F.col("node"))
        small = joined.select(F.col("root").alias("low"), F.col("low").alias("high")).where("low < high")
        small = small.unionByName(lowest.select(F.col("root").alias("low"), F.col("node").alias("high")))
        following = cut(small.distinct())
        changed = following.join(current, ["low", "high"], "left_anti").isEmpty() and current.join(following, ["low", "high"], "left_anti").isEmpty()
        if changed:
            return following.select(F.col("high").alias("node"), F.col("low").alias("root"))
        current = following
