"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents stand in a permuted line, repeated as often as its target
asks; the line is measured in words and cut into blocks. The mix takes the first
``quota`` blocks of each source. A tree splits these quotas among output shards:
at each node the blocks of the left half are a multivariate hypergeometric draw
from the node's quotas, the right half gets the rest. Every shard then draws its
own, disjoint range of each source's permuted block numbers and shuffles it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import RANK_ROWS, cut, word_count

WEIGHTS = (5, 2, 1)
#: No document is taken more often.
MOST = 3
BLOCK_WORDS = 1024
#: Above this many blocks they are made longer.
MOST_BLOCKS = 1 << 28
SEED = "mix-1"


def _order(seed: str) -> Column:
    """A permutation of the documents that any engine can recompute."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, rows, source_size, weight, target of every source.

    Sources in code-point order, null last, get the weights in turn. A target stops at ``most``
    times the source's size; what is over goes to the others by weight until none is above.
    """
    sources = cut(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")))
    # ranks without one task holding all sources: ranges of names, then a number within each range
    ranged = cut(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_range", F.spark_partition_id())
    )
    starts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")  # a row per shuffle partition
    place = F.row_number().over(Window.partitionBy("_range").orderBy(F.col("source").asc_nulls_last())) - 1
    turn = ((F.col("_start") + F.col("_place")) % len(weights)).cast("int")
    ranked = cut(
        ranged.withColumn("_place", place)
        .join(starts.select(F.col("_range"), earlier.alias("_start")), "_range")
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1))
        .drop("_place", "_start", "_range")
    )
    # water level: targets are weight * level, but full sources stop; the level only rises
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    full = F.lit(False)
    known = -1
    while True:
        filled = F.when(full, F.col("source_size") * most)
        taken, weight, stopped = ranked.agg(
            F.coalesce(F.sum(filled), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)), F.count(filled)
        ).first()
        level = (total - taken) / weight if weight else 0.0
        if stopped == known:
            break
        known = stopped
        full = full | (F.col("source_size") * most <= F.col("weight") * F.lit(level))
    target = F.when(full, (F.col("source_size") * most).cast("double")).otherwise(F.col("weight") * F.lit(level))
    return ranked.withColumn("target", target)


def split_quotas(quotas: np.ndarray, room: np.ndarray, seed: list[int]) -> np.ndarray:
    """Blocks of each source (rows) for each shard (columns) whose capacities are ``room``."""
    out = np.zeros((len(quotas), len(room)), np.int64)

    def split(left: int, right: int, own: np.ndarray) -> None:
        if right - left == 1:
            out[:, left] = own
            return
        middle = (left + right) // 2
        generator = np.random.default_rng([*seed, left, right])
        drawn = np.zeros_like(own)
        wanted, rest = int(room[left:middle].sum()), int(own.sum())
        for at, blocks in enumerate(own.tolist()):
            rest -= blocks
            drawn[at] = generator.hypergeometric(blocks, rest, wanted) if wanted and blocks else 0
            wanted -= int(drawn[at])
        split(left, middle, drawn)
        split(middle, right, own - drawn)

    split(0, len(room), quotas)
    return out


#: Sources whose quotas one task splits.
SOURCES_PER_TASK = 4096


def shard_quotas(targets: DataFrame, block_words: int, shards: int, seed: str) -> DataFrame:
    """source, shard, first (its first permuted block), blocks, quota, factor, shift.

    Two tiers, so that no task holds all sources: totals of groups of sources are split first, then
    each group splits its sources' quotas into the rooms it was given.
    """
    number = int.from_bytes(seed.encode()[:8], "big")
    with_quota = targets.select(
        "source",
        F.ceil(F.col("words") / F.lit(block_words)).cast("long").alias("quota"),
        F.pmod(F.xxhash64("source"), F.lit(SOURCES_PER_TASK)).cast("int").alias("part"),
    )
    with_quota = cut(with_quota)
    n_sources = max(1, with_quota.count())
    parts = min(SOURCES_PER_TASK, -(-n_sources // SOURCES_PER_TASK))
    with_quota = with_quota.withColumn("part", F.col("part") % parts)
    totals = with_quota.groupBy("part").agg(F.sum("quota").alias("quota"))

    def outer(group: pd.DataFrame) -> pd.DataFrame:  # at most SOURCES_PER_TASK rows
        group = group.sort_values("part", ignore_index=True)
        blocks = int(group["quota"].sum())
        room = np.array([blocks * (at + 1) // shards - blocks * at // shards for at in range(shards)], np.int64)
        rooms = split_quotas(group["quota"].to_numpy(np.int64), room, [number])
        return pd.DataFrame({"part": group["part"], "room": [row.tolist() for row in rooms]})

    rooms = totals.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(outer, "part int, room array<long>")

    def inner(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("source", ignore_index=True, na_position="last")
        quotas = group["quota"].to_numpy(np.int64)
        room = np.array(group["room"].iloc[0], np.int64)
        blocks = split_quotas(quotas, room, [number, int(group["part"].iloc[0]) + 1])
        generator = np.random.default_rng([number, int(group["part"].iloc[0]) + 1, 0, 1])
        factors, shifts = [], []
        for quota in quotas.tolist():
            factor = int(generator.integers(1, quota + 1)) if quota else 1
            while quota and math.gcd(factor, quota) != 1:
                factor = factor % quota + 1
            factors.append(factor)
            shifts.append(int(generator.integers(0, quota)) if quota else 0)
        ends = blocks.cumsum(axis=1)
        return pd.DataFrame(
            {
                "source": np.repeat(group["source"].to_numpy(object), shards),
                "shard": np.tile(np.arange(shards), len(group)),
                "first": (ends - blocks).ravel(),
                "blocks": blocks.ravel(),
                "quota": np.repeat(quotas, shards),
                "factor": np.repeat(factors, shards),
                "shift": np.repeat(shifts, shards),
            }
        )

    schema = "source string, shard int, first long, blocks long, quota long, factor long, shift long"
    return with_quota.join(rooms, "part").groupBy("part").applyInPandas(inner, schema)


#: Documents on either side of the end of a source's line that may change places.
NEAR_END = 8


def at_documents(lined: DataFrame) -> DataFrame:
    """source, row_key, start, words: the documents at the end of each source's line, so ordered that it ends with one.

    Of up to 16 documents around the end those are taken whole whose words come nearest to the target; of
    equally near choices the larger, then the one that changes the line least. A source with a target is
    never left empty. A line that ends with a copy of the whole source, or without words, has no rows here.
    """
    near = (
        lined.withColumn("_past", F.expr("words % nullif(source_size, 0)"))
        .where((F.col("size") > 0) & (F.col("_past") > 0))
        .withColumn("_before", F.col("start") < F.col("_past"))
    )
    # documents with words have different starts; a filtered rank sends a few rows per task and source
    rank = F.row_number().over(Window.partitionBy("source", "_before").orderBy(F.abs(F.col("start") - F.col("_past"))))
    near = near.withColumn("_rank", rank).where(F.col("_rank") <= NEAR_END)

    def choose(group: pd.DataFrame) -> pd.DataFrame:  # at most 2 * NEAR_END rows
        group = group.sort_values("start", ignore_index=True)
        sizes = group["size"].to_numpy(np.int64)
        first, past, words = (int(group[name].iloc[0]) for name in ("start", "_past", "words"))
        sums = np.zeros(1, np.int64)  # words of every choice; document n is bit n
        for size in sizes.tolist():
            sums = np.concatenate([sums, sums + size])
        off = np.abs(sums - (past - first))
        if words == past and first == 0:
            off[0] = np.iinfo(np.int64).max
        nearest = np.flatnonzero(off == off.min())
        nearest = nearest[sums[nearest] == sums[nearest].max()]
        bits = np.arange(len(sizes))
        chosen = nearest[:, None] >> bits & 1 == 1
        chosen = chosen[(chosen != (group["start"].to_numpy(np.int64) + sizes <= past)).sum(axis=1).argmin()]
        order = np.argsort(~chosen, kind="stable")
        ends = first + sizes[order].cumsum()
        return pd.DataFrame(
            {
                "source": group["source"],
                "row_key": group["row_key"].to_numpy()[order],
                "start": ends - sizes[order],
                "words": words - past + first + int(sizes[chosen].sum()),
            }
        )

    near = near.select("source", "row_key", "size", "start", "words", "_past")
    return near.groupBy("source").applyInPandas(choose, "source string, row_key long, start long, words long")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    shards: int = 16,
    block_words: int = BLOCK_WORDS,
    seed: str = SEED,
    whole_documents: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The documents with their source's target, and the pieces that the shards drew.

    Documents: row_key, doc_id, text_key, source, size, source_size, target. Pieces: row_key, shard, place
    (order within the shard), epoch, from_word, words; a piece is a run of one document's words in one block.

    A null or blank text has no words and gives no piece; a null source is a source; rows that
    agree in doc_id are separate documents that stand next to each other. An empty table gives two
    empty results; other columns are not read.

    Targets are met to the word, so one copy of a source counts with a part of its words; with ``whole_documents``
    every copy counts whole, and a source's words are as near to its target as ``at_documents`` brings them.
    """
    sized = cut(
        docs.select(
            "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_key")
        )
        .withColumn("row_key", F.monotonically_increasing_id())
        .withColumn("_order", _order(seed))
    )
    targets = cut(
        source_targets(sized, weights, most).withColumn(
            "words", F.least(F.col("source_size") * most, F.round("target").cast("long"))
        )
    )
    total, rows = sized.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    block_words = max(block_words, -(-total // MOST_BLOCKS))
    # where each document starts in its source's line: sums within cells of the permutation, then of cells
    cells = 1
    while cells * RANK_ROWS < rows and cells < 1 << 24:
        cells *= 16
    digits = max(1, len(f"{cells - 1:x}")) if cells > 1 else 0
    dealt = sized.withColumn("_cell", F.substring("_order", 1, digits) if digits else F.lit(""))
    sums = dealt.groupBy(F.col("source").alias("_of"), F.col("_cell").alias("_in")).agg(F.sum("size").alias("_size"))
    sums = sums.withColumn("_base", F.sum("_size").over(Window.partitionBy("_of").orderBy("_in")) - F.col("_size"))
    within = Window.partitionBy("source", "_cell").orderBy("_order", "size", "row_key")
    lined = (
        dealt.withColumn("_end", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .join(sums, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_cell") == F.col("_in")))
        .withColumn("start", F.col("_base") + F.col("_end") - F.col("size"))
        .select("row_key", "doc_id", "text_key", "source", "size", "start")
    )
    known = targets.withColumnRenamed("source", "_of").drop("rows")
    lined = cut(lined.join(known, F.col("source").eqNullSafe(F.col("_of"))).drop("_of"))
    if whole_documents:
        moved = cut(at_documents(lined))
        ends = moved.groupBy(F.col("source").alias("_of")).agg(F.max("words").alias("_words"))
        starts = moved.select("row_key", F.col("start").alias("_start"))

        def ended(rows: DataFrame) -> DataFrame:
            rows = rows.join(ends, F.col("source").eqNullSafe(F.col("_of")), "left")
            return rows.withColumn("words", F.coalesce("_words", "words")).drop("_of", "_words")

        lined = ended(lined.join(starts, "row_key", "left").withColumn("start", F.coalesce("_start", "start")).drop("_start"))
        lined, targets = cut(lined), cut(ended(targets))

    # each copy of a document lies at start + epoch * source_size; it is cut where the mix ends and at block ends
    copies = (
        lined.where(F.col("size") > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        .withColumn("_at", F.col("start") + F.col("epoch") * F.col("source_size"))
        .where(F.col("_at") < F.col("words"))
        .withColumn("_to", F.least(F.col("_at") + F.col("size"), F.col("words")))
    )
    in_blocks = copies.withColumn(
        "block", F.explode(F.sequence(F.expr(f"_at div {block_words}"), F.expr(f"(_to - 1) div {block_words}")))
    )
    low = F.greatest(F.col("_at"), F.col("block") * block_words)
    high = F.least(F.col("_to"), (F.col("block") + 1) * block_words)
    quotas = cut(shard_quotas(targets, block_words, shards, seed))
    pieces = in_blocks.select(
        "row_key", "source", "epoch", "block", (low - F.col("_at")).alias("from_word"), (high - low).alias("words")
    )
    lines = quotas.groupBy(F.col("source").alias("_of"), "quota", "factor", "shift").agg(
        F.array_sort(F.collect_list(F.struct("first", "shard", "blocks"))).alias("ranges")  # one entry per shard
    )
    drawn = F.pmod(F.col("block") * F.col("factor") + F.col("shift"), F.col("quota"))
    shard = F.expr("try_element_at(filter(ranges, r -> _drawn >= r.first AND _drawn < r.first + r.blocks), 1).shard")
    pieces = (
        pieces.join(lines, F.col("source").eqNullSafe(F.col("_of")), "left")
        .withColumn("_drawn", drawn)
        .withColumn("shard", F.coalesce(shard, F.raise_error(F.lit("no shard drew a block of the mix"))))
        .withColumn("place", F.xxhash64(F.lit(seed), "source", "block", "row_key"))
        .select("row_key", "shard", "place", "epoch", "from_word", "words")
    )
    return lined.drop("start", "words", "weight"), pieces


def _drawn_words(name: str) -> Column:
    """Words that shards drew; reading the shard raises an error for a block that none did."""
    return F.sum(F.when(F.col("shard") >= 0, F.col("words"))).alias(name)


def taken_words(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words that the mix takes of each document."""
    lined, pieces = mix(docs, **how)
    sums = pieces.groupBy("row_key").agg(_drawn_words("taken"))
    return lined.join(sums, "row_key", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_rows(docs: DataFrame, seed: str = SEED, shards: int = 16, placed: tuple[str, str] | None = None, **how) -> DataFrame:
    """The mix as rows of ``docs``, each unchanged: one for each time a document is taken, by shard in the order of place.

    A copy belongs to the shard that drew the block with its first word; within a shard copies stand in a shuffled
    order. A partition of the result is a stretch of one shard, so written files follow both. ``placed`` names two
    columns that get shard and place (an unsigned order as a hash). Rows that agree in doc_id, source and text are
    interchangeable. What ``mix`` says of nulls, blank texts and empty tables holds; no copy is cut.
    """
    if placed and set(placed) & set(docs.columns):
        raise ValueError(f"{placed}: there are columns of that name")
    lined, pieces = mix(docs, seed=seed, shards=shards, whole_documents=True, **how)
    copies = pieces.groupBy("row_key", "epoch").agg(F.min_by("shard", "from_word").alias("_shard")).join(lined, "row_key")
    copies = copies.select(
        F.col("doc_id").alias("_id"),
        F.col("source").alias("_source"),
        F.col("text_key").alias("_key"),
        "_shard",
        F.xxhash64(F.lit(seed), "source", "doc_id", "text_key", "epoch", F.lit("place")).alias("_place"),
    )
    # equal rows are one here; each of them has its own copies on the other side. A row travels as one column
    ones = (
        docs.select("doc_id", F.col("source").cast("string").alias("_s"), F.xxhash64("text").alias("_k"), F.struct("*").alias("_row"))
        .groupBy(F.col("doc_id").alias("_of_id"), F.col("_s").alias("_of_source"), F.col("_k").alias("_of_key"))
        .agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    )
    taken = copies.join(
        ones,
        F.col("_id").eqNullSafe(F.col("_of_id")) & F.col("_source").eqNullSafe(F.col("_of_source")) & (F.col("_key") == F.col("_of_key")),
    )
    # a shard is as many stretches of place as the shuffle has partitions for it
    stretches = max(1, -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards))
    stretch = F.expr(f"CAST(shiftrightunsigned(_place, 40) * {stretches} div {1 << 24} AS INT)")
    ordered = (
        taken.select("_shard", "_place", "_row")
        .repartitionById(shards * stretches, F.col("_shard") * stretches + stretch)
        .sortWithinPartitions("_shard", "_place")
    )
    added = [F.col(own).alias(name) for own, name in zip(("_shard", "_place"), placed or ())]
    return ordered.select("_row.*", *added)
