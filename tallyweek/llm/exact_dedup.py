"""Exact deduplication with a heavy-hitter split.

Every text is reduced to the digest of its normal form. Misra-Gries summaries,
one per task, name the few digests that may be frequent; their true counts are
taken and those that are frequent are settled in a table of at most ``counters``
rows, which is broadcast and applied map-side. Only the other digests, none of
which can be large, are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut

#: A digest is heavy if it has more than one in so many rows.
COUNTERS = 1024


def misra_gries(keys: np.ndarray, counts: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge weighted keys into a summary of at most ``counters`` keys.

    A key's remaining count is low by at most the sum of all counts over
    ``counters + 1``, also after any number of merges.
    """
    keys, place = np.unique(keys, return_inverse=True)
    counts = np.bincount(place, weights=counts, minlength=len(keys)).astype(np.int64)
    if len(keys) > counters:
        least = np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1]
        counts = counts - least
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def frequent_digests(digests: DataFrame, counters: int) -> DataFrame:
    """The digests (column ``digest``) with more than one in ``counters`` rows, with the row that stays.

    At most ``counters`` rows come out. The summaries find candidates; the counts are taken from all rows.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, rows = np.empty(0, "S32"), np.empty(0, np.int64), 0
        for batch in batches:
            new = np.frombuffer(b"".join(batch.column(0).to_pylist()), "S32")
            # numpy strips trailing zero bytes of S32 in comparisons and on the way out: both sides alike
            keys, counts = misra_gries(np.concatenate([keys, new]), np.concatenate([counts, np.ones(len(new), np.int64)]), counters)
            rows += len(new)
        padded = [bytes(key).ljust(32, b"\0") for key in keys]
        yield pa.RecordBatch.from_arrays(
            [pa.array(padded, pa.binary()), pa.array(counts, pa.int64())], names=["digest", "seen"]
        )

    rows = digests.count()
    summaries = digests.select("digest").mapInArrow(summarise, "digest binary, seen long")
    # a digest in more than 2 / counters of the rows keeps more than 1 / counters of them in the summed
    # summaries; no more than `counters` digests can, so the candidate table is bounded
    candidates = cut(
        summaries.groupBy("digest").agg(F.sum("seen").alias("seen")).where(F.col("seen") * counters > rows).select("digest")
    )
    return (
        digests.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "row_key")).alias("winner"), F.count("*").alias("group_size"))
        .where(F.col("group_size") * counters > rows)
    )


def _digest() -> Column:
    return F.unhex(F.sha2(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), 256))


def _split(docs: DataFrame, counters: int) -> tuple[DataFrame, DataFrame]:
    """Digest rows, numbered, and the winners of the heavy digests."""
    rows = cut(docs.select("doc_id", _digest().alias("digest")).withColumn("row_key", F.monotonically_increasing_id()))
    return rows, cut(frequent_digests(rows, counters))


def _decided(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    settled = rows.join(F.broadcast(heavy), "digest")
    others = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    copies = Window.partitionBy("digest")
    others = others.withColumn("winner", F.max(F.struct("doc_id", "row_key")).over(copies)).withColumn(
        "group_size", F.count(F.lit(1)).over(copies)
    )
    return settled.unionByName(others).select(
        "doc_id",
        "digest",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_key") == F.col("winner.row_key")).alias("kept"),
        "row_key",
    )


def decisions(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, digest, keep_id, group_size, kept, row_key.

    Texts are equal if they agree after lower-casing A-Z; a null text equals the
    empty one. The row with the largest doc_id stays; a null doc_id is smaller
    than any other. Of rows that agree in doc_id too, one stays (``row_key``
    numbers the rows of this result). An empty table gives an empty result;
    other columns are not read.
    """
    return _decided(*_split(docs, counters))


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with all their columns.

    Copies of heavy digests go map-side. Of rows with one text and one doc_id that differ elsewhere
    the first by the hash of all columns stays.
    """
    rows, heavy = _split(docs, counters)
    losers = heavy.select(F.col("digest").alias("_heavy"), F.col("winner.doc_id").alias("_stays"))
    # the row travels as one column, so no name in it meets a name of this function
    marked = docs.select("doc_id", _digest().alias("_digest"), F.struct("*").alias("_row")).join(
        F.broadcast(losers), (F.col("_digest") == F.col("_heavy")) & ~F.col("doc_id").eqNullSafe(F.col("_stays")), "left_anti"
    )
    groups = (
        _decided(rows, heavy)
        .where(F.col("group_size") > 1)
        .groupBy(F.col("digest").alias("_of"))
        .agg(
            F.max("keep_id").alias("_keep_id"),
            F.count(F.when(F.col("doc_id").eqNullSafe(F.col("keep_id")), 1)).alias("_same"),
        )
    )
    marked = marked.join(cut(groups), F.col("_digest") == F.col("_of"), "left")
    marked = marked.where(F.col("_of").isNull() | F.col("doc_id").eqNullSafe(F.col("_keep_id")))
    repeated = marked.where(F.col("_same") > 1).groupBy("_digest").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    ones = marked.where(F.col("_of").isNull() | (F.col("_same") == 1))
    return ones.select("_row").unionByName(repeated.select("_row")).select("_row.*")
