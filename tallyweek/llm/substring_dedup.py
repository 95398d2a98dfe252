"""Substring deduplication over fixed-length word windows.

Rabin-Karp hashes of all windows are counted in Spark in two rounds. The first
sends a short fingerprint of each window and names the few windows that may be
repeated; the second sends 96 bits of those and finds the smallest doc_id that
holds each. Windows that an earlier document holds cover words; neighbouring
covered words form maximal removal intervals.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import packed
from .rolling import BASES, Block

WIDTH = 13
#: A null doc_id counts as larger than any other.
LAST = np.iinfo(np.int64).max


def _ids(table: pa.Table) -> np.ndarray:
    return table["doc_id"].cast(pa.int64()).fill_null(LAST).to_numpy()


def _second(block: Block, first: np.ndarray, width: int) -> np.ndarray:
    """The other 32 bits of the windows that begin at ``first``."""
    at, hashes = block.windows(block.words(BASES[1]), width, BASES[1])
    return hashes[np.searchsorted(at, first)].astype(np.uint32)


def _candidates(block: Block, ids: np.ndarray, answers: pa.Table, width: int, buckets: int) -> tuple[np.ndarray, ...]:
    """key, second, smallest id, whether several texts hold it: of the block's windows that may be repeated."""
    nothing = tuple(np.empty(0, kind) for kind in ("u8", "u4", "i8", "u1"))
    first, hashes = block.windows(block.words(), width)
    if not len(hashes):
        return nothing
    order = np.argsort(hashes, kind="stable")
    keys, holders = hashes[order], ids[block.owner[first[order]]]
    begins = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    least, most = np.minimum.reduceat(holders, begins), np.maximum.reduceat(holders, begins)
    wanted = (least != most) | packed.maybe_shared(keys[begins], buckets, answers)
    if not wanted.any():
        return nothing
    picked = np.repeat(wanted, np.diff(begins, append=len(keys)))
    keys, holders, seconds = keys[picked], holders[picked], _second(block, first[order[picked]], width)
    order = np.lexsort((holders, seconds, keys))
    keys, holders, seconds = keys[order], holders[order], seconds[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (seconds[1:] != seconds[:-1])
    begins = np.flatnonzero(fresh)
    ends = np.append(begins[1:], len(keys)) - 1
    return keys[begins], seconds[begins], holders[begins], (holders[begins] != holders[ends]).astype(np.uint8)


def removal(docs: DataFrame, width: int = WIDTH, texts: bool = True, block_bytes: int = packed.BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, removed (intervals of words), n_removed, kept_sha256 and, with ``texts``, kept.

    A word goes if a window over it also starts in a row with a smaller doc_id; rows with one doc_id
    are never earlier than each other, a null doc_id is the largest. Texts shorter than a window, null
    and blank ones lose nothing. What is kept is joined by single spaces. An empty table gives an empty
    result; other columns are not read.
    """
    picked = docs.select("doc_id", "text")
    size = packed.text_bytes(picked)
    buckets = packed.bucket_count(size)
    blocks = packed.with_blocks(picked, size, block_bytes)

    def first_round(table: pa.Table) -> pa.Table:
        block = Block(packed.texts_of(table))
        keys = np.unique(block.windows(block.words(), width)[1])
        return pa.Table.from_batches([packed.sendings(table["block"][0].as_py(), keys, buckets, ["key"], [packed.short(keys)])])

    def second_round(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return no_sendings
        block, ids = Block(packed.texts_of(table)), _ids(table)
        found = _candidates(block, ids, answers, width, buckets)
        return pa.Table.from_batches(
            [packed.sendings(table["block"][0].as_py(), found[0], buckets, ["key", "second", "least", "several"], found)]
        )

    def earliest(table: pa.Table) -> pa.Table:
        """For each block, the windows of a bucket that several rows of the corpus hold, and the smallest doc_id."""
        parts = [packed.unpacked(table[name], kind) for name, kind in (("key", "<u8"), ("second", "<u4"), ("least", "<i8"), ("several", "u1"))]
        sizes = [len(part) for part in parts[0]]
        keys, seconds, least, several = (np.concatenate(part) for part in parts)
        order = np.lexsort((least, seconds, keys))
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[order][1:] != keys[order][:-1]) | (seconds[order][1:] != seconds[order][:-1])
        begins = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        ends = np.append(begins[1:], len(keys)) - 1
        smallest = least[order[begins]]
        shared = (smallest != least[order[ends]]) | (np.maximum.reduceat(several[order], begins) > 0)
        of = np.empty(len(keys), np.int64)
        of[order] = group
        out = {"block": [], "key": [], "least": []}
        at = 0
        for block, count in zip(table["block"].to_pylist(), sizes, strict=True):
            part = slice(at, at + count)
            at += count
            kept = shared[of[part]]
            if kept.any():
                out["block"].append(block)
                out["key"].append(keys[part][kept].tobytes())
                out["least"].append(smallest[of[part][kept]].tobytes())
        return pa.table({"block": pa.array(out["block"], pa.int32()), "key": pa.array(out["key"], pa.binary()), "least": pa.array(out["least"], pa.binary())})

    def cover(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return no_rows
        block, ids = Block(packed.texts_of(table)), _ids(table)
        words = len(block.starts)
        gone = np.zeros(words, bool)
        if answers.num_rows and words >= width:
            keys = np.concatenate(packed.unpacked(answers["key"], "<u8"))
            least = np.concatenate(packed.unpacked(answers["least"], "<i8"))
            order = np.argsort(keys, kind="stable")
            keys, least = keys[order], least[order]
            first, hashes = block.windows(block.words(), width)
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            first = first[(keys[at] == hashes) & (least[at] < ids[block.owner[first]])]
            steps = np.zeros(words + 1, np.int64)
            np.add.at(steps, first, 1)
            np.add.at(steps, first + width, -1)
            gone = np.cumsum(steps)[:-1] > 0
        return _described(table, block, gone, texts)

    id_type = picked.schema["doc_id"].dataType.simpleString()
    out_schema = f"doc_id {id_type}, n_words long, removed array<struct<first: int, last: int>>, n_removed long, kept_sha256 string"
    out_schema += ", kept string" if texts else ""
    sent_schema = "bucket int, block int, key binary, second binary, least binary, several binary"
    no_rows, no_sendings = packed.nothing(out_schema), packed.nothing(sent_schema)
    answers = blocks.groupBy("block").applyInArrow(first_round, "bucket int, block int, key binary")
    answers = answers.groupBy("bucket").applyInArrow(packed.answer_shared, packed.ANSWER)
    sent = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(second_round, sent_schema)
    found = sent.groupBy("bucket").applyInArrow(earliest, "block int, key binary, least binary")
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(cover, out_schema)


def _described(table: pa.Table, block: Block, gone: np.ndarray, texts: bool) -> pa.Table:
    """The result rows of a block whose words marked ``gone`` go."""
    n_words = np.diff(block.bounds)
    counts = np.concatenate([[0], np.cumsum(gone)])
    # bytes of kept words, each with the blank behind it made a space; a byte of memory per byte
    steps = np.zeros(len(block.data) + 1, np.int8)
    steps[block.starts[~gone]] += 1
    steps[block.ends[~gone] + 1] -= 1
    kept = np.cumsum(steps[:-1], dtype=np.int8, out=steps[:-1]).view(bool)
    data = np.where(block.blank, np.uint8(0x20), block.data)[kept].tobytes()
    begins = np.concatenate([[0], block.text_ends[:-1]])
    sizes = np.add.reduceat(kept, begins, dtype=np.int64)
    ends = np.cumsum(sizes)
    pieces = [data[end - size : max(end - 1, end - size)] for end, size in zip(ends.tolist(), sizes.tolist(), strict=True)]
    # intervals, cut at the borders of texts
    fresh = gone & np.concatenate([[True], ~gone[:-1] | (block.owner[1:] != block.owner[:-1])])[: len(gone)]
    final = gone & np.concatenate([~gone[1:] | (block.owner[1:] != block.owner[:-1]), [True]])[: len(gone)]
    begins, lasts = np.flatnonzero(fresh), np.flatnonzero(final)
    base = block.bounds[:-1][block.owner[begins]] if len(begins) else begins
    intervals = pa.StructArray.from_arrays(
        [pa.array(begins - base, pa.int32()), pa.array(lasts - base, pa.int32())], names=["first", "last"]
    )
    offsets = np.concatenate([[0], np.cumsum(np.bincount(block.owner[begins], minlength=len(n_words)))]).astype(np.int32)
    columns = {
        "doc_id": table["doc_id"],
        "n_words": pa.array(n_words, pa.int64()),
        "removed": pa.ListArray.from_arrays(offsets, intervals),
        "n_removed": pa.array(counts[block.bounds[1:]] - counts[block.bounds[:-1]], pa.int64()),
        "kept_sha256": pa.array([hashlib.sha256(piece).hexdigest() for piece in pieces], pa.string()),
    }
    if texts:
        columns["kept"] = pa.array([piece.decode() for piece in pieces], pa.string())
    return pa.table(columns)
