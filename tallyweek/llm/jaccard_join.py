"""N-gram Jaccard join by vertical partitioning.

1. Shingles that no other text has cannot link; counting all shingles in packed
   form leaves the few texts that share enough, and of equal sets one.
2. The shingles of these, rarest first, are the global order. Two sets that link
   share a shingle within the first few of both (the prefix); classes joined by
   shared prefix shingles form clusters.
3. The order is cut into fragments. Each task takes one fragment of some
   clusters' pairs of chunks, counts partial overlaps, and drops pairs whose
   fragments already differ by more than linked sets may.
4. Partial overlaps are summed per pair; pairs that reach the threshold link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import packed
from .common import cut
from .graph import components, forest
from .rolling import BASES, Block, mixed, span_hashes

WIDTH = 4
#: Two sets link if 100 * intersection >= PERCENT * union.
PERCENT = 85
FRAGMENTS = 4
#: Classes of a cluster that are compared with each other at once.
CHUNK = 256
#: Shingles of one block of classes.
BLOCK_SHINGLES = 1 << 20
#: Pairs of chunks that one task takes together, roughly.
UNITS_PER_TASK = 64


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """The smallest overlap that a set of ``n`` needs with any other to link."""
    return -(-n * percent // 100)


def all_shingles(block: Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every shingle; a text with fewer words than ``width`` has its whole sequence as one."""
    words = block.words()
    first, hashes = block.windows(words, width)
    counts = np.diff(block.bounds)
    brief = np.flatnonzero((counts > 0) & (counts < width))
    whole = span_hashes(words, block.bounds[brief], block.bounds[brief + 1], BASES[1])
    return np.concatenate([block.owner[first], brief]), np.concatenate([hashes, whole])


def shingles(block: Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every distinct shingle, ascending by text and hash."""
    owner, hashes = all_shingles(block, width)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[fresh], hashes[fresh]


def _offsets(owner: np.ndarray, count: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count))]).astype(np.int64)


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    data = values.tobytes()
    width = values.dtype.itemsize
    return pa.array([data[a * width : b * width] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.binary())


def shingle_sets(docs: DataFrame, width: int, percent: int, block_bytes: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key and, where enough of them may be shared, shared (packed) of every row."""
    picked = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    size = packed.text_bytes(picked)
    buckets = packed.bucket_count(size)
    blocks = packed.with_blocks(picked, size, block_bytes)

    def send(table: pa.Table) -> pa.Table:
        keys = np.unique(all_shingles(Block(packed.texts_of(table), lower=True), width)[1])
        return pa.Table.from_batches([packed.sendings(table["block"][0].as_py(), keys, buckets, ["key"], [packed.short(keys)])])

    def select(table: pa.Table, answers: pa.Table) -> pa.Table:
        count = table.num_rows
        if not count:
            return no_rows
        owner, hashes = shingles(Block(packed.texts_of(table), lower=True), width)
        keys, place, times = np.unique(hashes, return_inverse=True, return_counts=True)
        shared = ((times > 1) | packed.maybe_shared(keys, buckets, answers))[place]
        n = np.bincount(owner, minlength=count)
        enough = (np.bincount(owner[shared], minlength=count) >= least_overlap(n, percent)) & (n > 0)
        spread, sums = mixed(hashes), np.zeros(count, np.uint64)
        np.add.at(sums, owner, spread)
        kept = shared & enough[owner]
        found = _binaries(hashes[kept], _offsets(owner[kept], count))
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "text_key": table["text_key"],
                "n_shingles": pa.array(n, pa.int64()),
                "set_key": pa.array(mixed(sums ^ n.astype(np.uint64)).astype(np.int64), pa.int64()),
                "shared": pa.array(found.to_pylist(), pa.binary(), mask=~enough),
            }
        )

    schema = f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, text_key long, n_shingles long, set_key long, shared binary"
    no_rows = packed.nothing(schema)
    answers = blocks.groupBy("block").applyInArrow(send, "bucket int, block int, key binary")
    answers = answers.groupBy("bucket").applyInArrow(packed.answer_shared, packed.ANSWER)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(select, schema)


def _class_table(sets: DataFrame) -> DataFrame:
    """set_key, n, shared: one row for each different set that has enough shared shingles."""
    one = Window.partitionBy("set_key").orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("shared"))
    return (
        sets.where(F.col("shared").isNotNull())
        .withColumn("_nth", F.row_number().over(one))
        .where("_nth = 1")
        .select("set_key", F.col("n_shingles").alias("n"), "shared")
    )


def ordered_classes(sets: DataFrame, percent: int) -> DataFrame:
    """set_key, n, tokens (shared by two classes, in global order), counts (of classes), prefix (how many of tokens).

    Equal sets are one class; classes that cannot link any more are left out.
    """
    classes = _class_table(sets)
    # counted before equal sets meet, which is enough to size blocks
    total = sets.agg(F.coalesce(F.sum(F.octet_length("shared")), F.lit(0))).first()[0] // 8
    blocks, buckets = max(1, -(-total // BLOCK_SHINGLES)), packed.LEAST_BUCKETS + total // (1 << 18)
    grouped = classes.withColumn("block", F.pmod(F.xxhash64("set_key"), F.lit(blocks)).cast("int"))

    def send(table: pa.Table) -> pa.Table:
        keys, counts = np.unique(np.concatenate(packed.unpacked(table["shared"], "<u8")), return_counts=True)
        return pa.Table.from_batches(
            [packed.sendings(table["block"][0].as_py(), keys, buckets, ["key", "seen"], [keys, counts.astype("<u4")])]
        )

    def count(table: pa.Table) -> pa.Table:
        sent, seen = packed.unpacked(table["key"], "<u8"), packed.unpacked(table["seen"], "<u4")
        keys, place = np.unique(np.concatenate(sent), return_inverse=True)
        totals = np.bincount(place, weights=np.concatenate(seen), minlength=len(keys)).astype("<u4")
        out = {"block": [], "key": [], "seen": []}
        for block, part in zip(table["block"].to_pylist(), sent, strict=True):
            own = totals[np.searchsorted(keys, part)]
            several = own > 1
            if several.any():
                out["block"].append(block)
                out["key"].append(part[several].tobytes())
                out["seen"].append(own[several].tobytes())
        return pa.table({"block": pa.array(out["block"], pa.int32()), "key": pa.array(out["key"], pa.binary()), "seen": pa.array(out["seen"], pa.binary())})

    def order(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return no_rows
        keys, seen = np.concatenate(packed.unpacked(answers["key"], "<u8")), np.concatenate(packed.unpacked(answers["seen"], "<u4"))
        at = np.argsort(keys)
        keys, seen = keys[at], seen[at]
        rows = []
        for key, n, tokens in zip(table["set_key"].to_pylist(), table["n"].to_pylist(), packed.unpacked(table["shared"], "<u8"), strict=True):
            tokens = tokens[packed.member(tokens, keys)]
            prefix = n - int(least_overlap(np.int64(n), percent)) + 1 - (n - len(tokens))
            if prefix > 0:
                counts = seen[np.searchsorted(keys, tokens)]
                rank = np.lexsort((tokens, counts))
                rows.append((key, n, tokens[rank].tobytes(), counts[rank].tobytes(), prefix))
        names = ["set_key", "n", "tokens", "counts", "prefix"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32()]
        return pa.table({name: pa.array([row[i] for row in rows], kind) for i, (name, kind) in enumerate(zip(names, kinds, strict=True))})

    schema = "set_key long, n long, tokens binary, counts binary, prefix int"
    no_rows = packed.nothing(schema)
    sent = grouped.groupBy("block").applyInArrow(send, "bucket int, block int, key binary, seen binary")
    answers = sent.groupBy("bucket").applyInArrow(count, "block int, key binary, seen binary")
    return grouped.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(order, schema)


def _prefix_rows(classes: DataFrame) -> DataFrame:
    """token, set_key for the prefix shingles of every class."""

    def run(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            tokens = [np.frombuffer(value.as_buffer(), "<i8")[:n] for value, n in zip(batch.column(1), batch.column(2).to_pylist(), strict=True)]
            keys = np.repeat(batch.column(0).to_numpy(), [len(part) for part in tokens])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.empty(0, "<i8"), *tokens])), pa.array(keys)], names=["token", "set_key"]
            )

    return classes.select("set_key", "tokens", "prefix").mapInArrow(run, "token long, set_key long")


def _segments(classes: DataFrame, fragments: int, pivots: list[tuple[int, int]]) -> DataFrame:
    """The classes with their tokens cut at the pivots (counts, token) of the global order: a row per fragment."""

    def run(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            rows = batch.to_pydict()
            out = {name: [] for name in (*passed, "fragment", "segment")}
            for at, tokens in enumerate(rows["tokens"]):
                order, counts = np.frombuffer(tokens, "<u8"), np.frombuffer(rows["counts"][at], "<u4")
                ends = [int(((counts < c) | ((counts == c) & (order < t))).sum()) for c, t in pivots]
                bounds = [0, *ends, len(order)]
                for fragment in range(fragments):
                    for name in passed:
                        out[name].append(rows[name][at])
                    out["fragment"].append(fragment)
                    out["segment"].append(order[bounds[fragment] : bounds[fragment + 1]].tobytes())
            kinds = [*[batch.schema.field(name).type for name in passed], pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(out.values(), kinds, strict=True)], names=list(out))

    passed = ["set_key", "n", "cluster", "chunk", "a", "b", "bin"]
    schema = "set_key long, n long, cluster long, chunk int, a int, b int, bin int, fragment int, segment binary"
    return classes.select(*passed, "tokens", "counts").mapInArrow(run, schema)


def partial_overlaps(segments: list[np.ndarray], sizes: np.ndarray, split: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and overlap of pairs of segments that may belong to linked sets.

    With ``split`` 0 all pairs (row < column) are looked at, else those of the first ``split`` with the rest.
    """
    count = len(segments)
    lengths = np.array([len(part) for part in segments])
    _, column = np.unique(np.concatenate(segments), return_inverse=True)
    row = np.repeat(np.arange(count), lengths)
    low, high = (np.arange(split), np.arange(split, count)) if split else (np.arange(count), np.arange(count))
    overlap = np.zeros((len(low), len(high)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        part = slice(*np.searchsorted(column, [first, first + 4096]))
        held = np.zeros((count, 4096), np.float32)
        held[row[part], column[part] - first] = 1
        overlap += held[low] @ held[high].T
    # linked sets differ by at most this much in all, so in any fragment
    both = sizes[low][:, None] + sizes[high][None, :]
    most = both - 2 * (-(-both * percent // (100 + percent)))
    differs = lengths[low][:, None] + lengths[high][None, :] - 2 * overlap
    possible = (differs <= most) & (overlap > 0)
    if not split:
        possible = np.triu(possible, 1)
    i, j = np.nonzero(possible)
    return low[i], high[j], overlap[i, j].astype(np.int64)


def links(classes: DataFrame, percent: int, fragments: int = FRAGMENTS, chunk: int = CHUNK) -> DataFrame:
    """low, high: set_keys joined by links (of each pair of chunks, as few as connect the same)."""
    prefixes = cut(_prefix_rows(classes))
    first = prefixes.groupBy("token").agg(F.min("set_key").alias("low"))
    clusters = components(prefixes.join(first, "token").select("low", F.col("set_key").alias("high")))
    # keys only: the shingles are joined to what is compared at the end, once
    placed = classes.select("set_key").join(clusters, F.col("set_key") == F.col("node"), "left")
    placed = placed.withColumn("cluster", F.coalesce("root", "set_key"))
    sizes = placed.groupBy("cluster").agg(F.count("*").alias("_classes")).where("_classes > 1")
    placed = placed.join(sizes, "cluster").withColumn(
        "chunk", F.pmod(F.xxhash64("set_key"), F.ceil(F.col("_classes") / chunk)).cast("int")
    )
    placed = cut(placed.select("set_key", "cluster", "chunk", (F.col("_classes") > chunk).alias("large")))
    # pairs of chunks that share a prefix shingle; a small cluster is one chunk
    small = placed.where(~F.col("large")).select("cluster", F.col("chunk").alias("a"), F.col("chunk").alias("b")).distinct()
    seen = prefixes.join(placed.where("large").select("set_key", "cluster", "chunk"), "set_key").select("token", "cluster", "chunk").distinct()
    pairs = (
        seen.withColumnRenamed("chunk", "a")
        .join(seen.withColumnRenamed("chunk", "b"), ["token", "cluster"])
        .where("a <= b")
        .select("cluster", "a", "b")
        .distinct()
        .unionByName(small)
    )
    units = cut(pairs)
    n_bins = max(1, -(-units.count() // UNITS_PER_TASK))
    units = units.withColumn("bin", F.pmod(F.xxhash64("cluster", "a", "b"), F.lit(n_bins)).cast("int"))
    sides = units.withColumn("chunk", F.explode(F.array_distinct(F.array("a", "b"))))

    # where the order is cut: between the classes' own quarters, in the middle of all classes
    def quarters(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            found: list[list[int]] = []
            for tokens, counts in zip(packed.unpacked(batch.column(0), "<u8"), packed.unpacked(batch.column(1), "<u4"), strict=True):
                found.append([int(counts[len(counts) * at // fragments]) for at in range(1, fragments)] if len(tokens) else [0] * (fragments - 1))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], names=["cuts"])

    cuts = classes.select("tokens", "counts").mapInArrow(quarters, "cuts array<int>")
    middle = cuts.agg(*[F.percentile_approx(F.col("cuts")[at], 0.5).alias(str(at)) for at in range(fragments - 1)]).first()
    # the same count twice: the second cut halves the tokens of that count
    pivots = [((1 << 63) if at and middle[at] == middle[at - 1] else 0, count or 0) for at, count in enumerate(middle)]
    pivots = sorted((count, token) for token, count in pivots)
    compared = placed.select("set_key", "cluster", "chunk").join(sides, ["cluster", "chunk"])
    rows = _segments(classes.join(compared, "set_key"), fragments, pivots)

    def overlap(table: pa.Table) -> pa.Table:
        rows = table.select(["cluster", "a", "b", "chunk", "set_key", "n"]).to_pandas()
        segments = packed.unpacked(table["segment"], "<u8")
        out = {name: [] for name in ("cluster", "a", "b", "left", "right", "sizes", "overlaps")}
        for (cluster, a, b), part in rows.groupby(["cluster", "a", "b"], sort=False):
            part = part.sort_values(["chunk", "set_key"])
            if len(part) < 2:
                continue
            split = int((part["chunk"] == a).sum()) if a != b else 0
            keys, n = part["set_key"].to_numpy(), part["n"].to_numpy()
            i, j, counts = partial_overlaps([segments[at] for at in part.index], n, split, percent)
            if len(i):
                for name, value in (("cluster", cluster), ("a", a), ("b", b)):
                    out[name].append(value)
                for name, values in (("left", keys[i]), ("right", keys[j]), ("sizes", n[i] + n[j]), ("overlaps", counts)):
                    out[name].append(values.astype("<i8" if name in ("left", "right") else "<i4").tobytes())
        kinds = {"cluster": pa.int64(), "a": pa.int32(), "b": pa.int32()}
        return pa.table({name: pa.array(values, kinds.get(name, pa.binary())) for name, values in out.items()})

    found = rows.groupBy("bin", "fragment").applyInArrow(
        overlap, "cluster long, a int, b int, left binary, right binary, sizes binary, overlaps binary"
    )
    found = found.withColumn("bin", F.pmod(F.xxhash64("cluster", "a", "b"), F.lit(n_bins)).cast("int")).drop("cluster", "a", "b")

    def total(table: pa.Table) -> pa.Table:
        left, right = (np.concatenate(packed.unpacked(table[name], "<i8")) for name in ("left", "right"))
        sizes, counts = (np.concatenate(packed.unpacked(table[name], "<i4")).astype(np.int64) for name in ("sizes", "overlaps"))
        order = np.lexsort((right, left))
        left, right, sizes = left[order], right[order], sizes[order]
        begins = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
        sums = np.add.reduceat(counts[order], begins)
        linked = 100 * sums >= percent * (sizes[begins] - sums)
        low, high = forest(left[begins][linked], right[begins][linked])
        return pa.table({"low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64())})

    return found.groupBy("bin").applyInArrow(total, "low long, high long")


def linked_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block_bytes: int = packed.BLOCK_BYTES) -> DataFrame:
    """doc_id, text_key (hash of the text), n_shingles, root (key of the group), component_id of every row.

    Words are lower-cased (A-Z) runs of non-blanks. Rows with equal sets are one node; a null, empty or
    blank text has no shingles, no root, and is linked with nothing. component_id is the smallest doc_id
    that links reach; null ids are the largest. Rows that agree in doc_id are rows of their own. An empty
    table gives an empty result; other columns are not read.
    """
    sets = cut(shingle_sets(docs, width, percent, block_bytes))
    classes = cut(ordered_classes(sets, percent))
    roots = cut(components(links(classes, percent)))
    has_words = F.col("n_shingles") > 0
    joined = (
        sets.drop("shared")
        .join(roots, F.col("set_key") == F.col("node"), "left")
        .withColumn("root", F.when(has_words, F.coalesce("root", "set_key")))
        .drop("node", "set_key")
    )
    least = joined.where(has_words).groupBy(F.col("root").alias("_root")).agg(F.min("doc_id").alias("_least"))
    return joined.join(least, F.col("root") == F.col("_root"), "left").select(
        "doc_id", "text_key", "n_shingles", "root", F.when(has_words, F.col("_least")).otherwise(F.col("doc_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block_bytes: int = packed.BLOCK_BYTES) -> DataFrame:
    """The rows, with all columns, that are no copy: of each linked group the row with the smallest doc_id stays.

    Rows without shingles are linked with nothing and all stay. Among rows of a group with that doc_id the
    first by the hashes of the text and of all columns stays.
    """
    groups = cut(linked_groups(docs, width, percent, block_bytes).where("n_shingles > 0"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    best = groups.groupBy(F.col("root").alias("_root")).agg(F.min(place).alias("_best"), F.count("*").alias("_rows")).where("_rows > 1")
    judged = groups.join(best, F.col("root") == F.col("_root")).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), (place == F.col("_best")).alias("_stays")
    )
    # a row per text that goes, and per text that stays once of several equal rows
    marks = judged.groupBy("_id", "_text").agg(F.max("_stays").alias("_stays"), F.count("*").alias("_times"))
    marks = cut(marks.where("NOT _stays OR _times > 1"))
    # the row travels as one column, so no name in it meets a name of this function
    rows = docs.select("doc_id", F.xxhash64("text").alias("_key"), F.struct("*").alias("_row"))
    marked = rows.join(marks, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_text")), "left")
    repeated = marked.where("_stays").groupBy("_id", "_text").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return marked.where("_stays IS NULL").select("_row").unionByName(repeated.select("_row")).select("_row.*")
