"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Equal texts form a group and go to one shard. Groups that weigh at least one
``units``-th of all bytes are units of their own; the others are dealt to
``units`` cells by their digest, and a cell is one unit. So the differencing sees
at most 2 x ``units`` numbers however large the corpus is, while its result is
as even as the smallest units allow.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered

UNITS = 8192


def karmarkar_karp(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size.

    Every size starts as a partition with one filled part. The two partitions with the largest
    spread are combined, the largest part of one with the smallest of the other, until one is left.
    """
    if not sizes:
        return []
    # nodes: leaves first, then (left, right, order of the right's parts met by the left's parts)
    made: list[tuple[int, int, np.ndarray]] = []
    parts = {}
    heap = []
    for leaf, size in enumerate(sizes):
        sums = np.zeros(shards, np.int64)
        sums[0] = size
        parts[leaf] = sums
        heap.append((-size if shards > 1 else 0, leaf))
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        left, right = parts.pop(a), parts.pop(b)
        met = np.empty(shards, np.int64)
        met[np.argsort(-left, kind="stable")] = np.argsort(right, kind="stable")
        node = len(sizes) + len(made)
        made.append((a, b, met))
        parts[node] = left + right[met]
        heapq.heappush(heap, (-int(np.ptp(parts[node])), node))
    # labels[node][part]: the final shard of that part, from the root down
    labels = {heap[0][1]: np.arange(shards)}
    for at in range(len(made) - 1, -1, -1):
        a, b, met = made[at]
        own = labels.pop(len(sizes) + at)
        labels[a] = own
        labels[b] = np.empty(shards, np.int64)
        labels[b][met] = own
    return [int(labels[leaf][0]) for leaf in range(len(sizes))]


def balanced_shards(docs: DataFrame, shards: int = 16, units: int = UNITS) -> DataFrame:
    """doc_id, size, text_crc32, digest, shard, slot for every row.

    Size is the text's UTF-8 bytes plus 1; a null text has no bytes and equals the empty text.
    Slots run from 0 without a gap within each shard; rows that agree in doc_id, text and size
    are interchangeable. An empty table gives an empty result; other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        )
    )
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    cell = F.concat(F.lit("cell "), F.pmod(F.xxhash64("digest"), F.lit(units)))
    groups = cut(rows.groupBy("digest").agg(F.sum("size").alias("bytes")))
    large = cut(groups.where(F.col("bytes") * units >= total).select("digest", F.concat(F.lit("own "), F.hex("digest")).alias("own"), "bytes"))
    small = groups.where(F.col("bytes") * units < total).groupBy(cell.alias("unit")).agg(F.sum("bytes").alias("bytes"))
    unit_sizes = small.unionByName(large.select(F.col("own").alias("unit"), "bytes"))

    def deal(all_units: pd.DataFrame) -> pd.DataFrame:
        all_units = all_units.sort_values("unit", ignore_index=True)
        return all_units.assign(shard=karmarkar_karp(all_units["bytes"].tolist(), shards))[["unit", "shard"]]

    # one group of at most 2 * units rows
    dealt = cut(unit_sizes.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(deal, "unit string, shard int"))
    placed = (
        rows.join(F.broadcast(large.select("digest", "own")), "digest", "left")
        .withColumn("unit", F.coalesce("own", cell))
        .join(F.broadcast(dealt), "unit")
        .drop("unit", "own")
    )
    return numbered(placed, "shard", ["doc_id", "digest"], "slot", count)
