"""Scores by prediction by partial matching over bytes, trained on the corpus.

The trie of byte contexts is never in one place. A block of texts sends the
distinct n-grams (context and next byte) that it holds, with their counts in
training texts, to buckets by the last two bytes of the context. A bucket so
holds all longer contexts that end there, derives every node's totals, escape
weights and exclusions, and answers each n-gram with its log probability. Only
the nodes of order 0 and 1, at most 256 x 257 counts, are broadcast.

Escapes are estimated by method D: a context with T occurrences of D different
bytes gives a byte seen c times (c - 1/2) / T and the escape D / (2 T). Between the
longest contexts and order 2 an n-gram counts once for every longer one that ends
in it (update exclusion). Bytes that a longer context has seen are excluded from
the shorter ones after an escape. Below order 0 the bytes never seen share alike.

A text is its words, A-Z lower-cased, joined by one space, then an end mark. The
base score is an add-one unigram model of the same words and end.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import packed
from .common import crc_of_id, cut
from .rolling import BASES, Block, mixed

#: Bytes of context.
ORDER = 5
#: Never part of a UTF-8 text: the end of a text, and what stands before its start.
END = 0xFF
#: The key of the end token.
END_KEY = np.uint64(1)
ALPHABET = 256
#: What a seen byte leaves to the escape.
LEFT = 0.5
BLOCK_BYTES = 8 << 20
#: Bytes of text whose n-grams are looked up at once.
PART_BYTES = 1 << 20
#: Stands for the row that brings the number of different training tokens.
TOTALS = -1


def training(docs: DataFrame, folds: int = 7, fold: int = 2) -> Column:
    return crc_of_id(docs["doc_id"]) % folds != fold


def canonical(texts: list[bytes | None]) -> list[bytes]:
    """Words in lower case with one space between them, and the end mark."""
    return [b" ".join((text or b"").lower().split()) + bytes([END]) for text in texts]


class Grams:
    """The different n-grams of a block's texts, ascending, and where each occurs."""

    def __init__(self, texts: list[bytes | None], order: int = ORDER) -> None:
        self.parts: list[tuple[int, np.ndarray, np.ndarray]] = []  # first text, length of each, n-gram at each byte
        found = []
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size < PART_BYTES):
                size += len(texts[to] or b"")
                to += 1
            place, codes, lengths = _part(canonical(texts[at:to]), order)
            self.parts.append((at, lengths, place))
            found.append(codes)
            at = to
        self.size = len(texts)
        self.codes, inverse = np.unique(np.concatenate(found), return_inverse=True)
        bounds = np.cumsum([0, *map(len, found)])
        for number, (first, lengths, place) in enumerate(self.parts):
            self.parts[number] = first, lengths, inverse[bounds[number] : bounds[number + 1]].astype(np.int32)[place]

    def counts(self, wanted: np.ndarray) -> np.ndarray:
        """How often each n-gram occurs in the texts marked ``wanted``."""
        out = np.zeros(len(self.codes), np.int64)
        for first, lengths, place in self.parts:
            out += np.bincount(place[np.repeat(wanted[first : first + len(lengths)], lengths)], minlength=len(out))
        return out

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum of the values of each text's n-grams."""
        out = np.zeros(self.size)
        for first, lengths, place in self.parts:
            out[first : first + len(lengths)] = np.add.reduceat(values[place], np.cumsum(lengths) - lengths)
        return out


def _part(parts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the bytes of some canonical texts: the place of each one's n-gram, the n-grams, the texts' lengths."""
    pad = bytes([END]) * order
    data = np.frombuffer(pad + pad.join(parts), np.uint8)
    lengths = np.array([len(part) for part in parts], np.int64)
    code = np.zeros(len(data) - order, np.uint64)
    for at in range(order + 1):
        code = (code << np.uint64(8)) | data[at : at + len(code)]
    # code p belongs to byte p + order; the pads between texts are skipped
    starts = np.cumsum(lengths + order) - lengths - order
    within = np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    place, codes = pd.factorize(code[within])
    return place.astype(np.int32), codes, lengths


def gram_buckets(codes: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed((codes >> np.uint64(8)) & np.uint64(0xFFFF)) % np.uint64(buckets)).astype(np.int64)


class Orders:
    """Counts of one order's n-grams, and of their contexts, after exclusion."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray) -> None:
        self.grams, place = np.unique(grams, return_inverse=True)
        self.counts = np.bincount(place, weights=counts, minlength=len(self.grams)).astype(np.int64)
        self.contexts, self.of = np.unique(self.grams >> np.uint64(8), return_inverse=True)
        size = len(self.contexts)
        self.total = np.bincount(self.of, weights=self.counts, minlength=size).astype(np.int64)
        self.different = np.bincount(self.of, weights=self.counts > 0, minlength=size).astype(np.int64)

    def count(self, grams: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.grams, grams), max(len(self.grams) - 1, 0))
        return np.where(self.grams[at] == grams, self.counts[at], 0) if len(self.grams) else np.zeros(len(grams), np.int64)

    def node(self, contexts: np.ndarray, values: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.contexts, contexts), max(len(self.contexts) - 1, 0))
        return np.where(self.contexts[at] == contexts, values[at], 0) if len(self.contexts) else np.zeros(len(contexts), np.int64)


def log_probabilities(codes: np.ndarray, counts: np.ndarray, low: np.ndarray, order: int) -> np.ndarray:
    """log10 of the chance of each n-gram's last byte after its context.

    ``codes`` with ``counts`` hold all n-grams of their contexts down to order 2; ``low`` counts the pairs
    of bytes in the corpus.
    """
    pairs = np.flatnonzero(low.ravel()).astype(np.uint64)
    # a byte's count in order 0 is that of all pairs that end in it
    singles = low.sum(axis=0)
    levels = {1: Orders(pairs, low.ravel()[pairs.astype(np.int64)]), 0: Orders(np.arange(256, dtype=np.uint64), singles)}
    levels[order] = Orders(codes, counts)
    for k in range(order - 1, 1, -1):
        longer_level = levels[k + 1]
        levels[k] = Orders(longer_level.grams & np.uint64((1 << 8 * (k + 1)) - 1), (longer_level.counts > 0).astype(np.int64))
    out, open_ = np.zeros(len(codes)), np.ones(len(codes), bool)
    longer = None
    for k in range(order, -1, -1):
        level = levels[k]
        grams = codes & np.uint64((1 << 8 * (k + 1)) - 1)
        contexts = grams >> np.uint64(8)
        total, different = level.node(contexts, level.total), level.node(contexts, level.different)
        if longer is not None:
            # what the longer context has seen, counted here, is excluded
            held = levels[k + 1]
            seen = np.where(held.counts > 0, level.count(held.grams & np.uint64((1 << 8 * (k + 1)) - 1)), 0)
            masses = np.bincount(held.of, weights=seen, minlength=len(held.contexts)).astype(np.int64)
            total -= held.node(longer, masses)
            different -= held.node(longer, held.different)
        own = level.count(grams)
        live = open_ & (total > 0)  # a context whose bytes are all excluded, or that is new, is passed over
        hit, miss = live & (own > 0), live & (own == 0)
        out[hit] += np.log10((own[hit] - LEFT) / total[hit])
        out[miss] += np.log10(LEFT * different[miss] / total[miss])
        open_ &= ~hit
        longer = contexts
    unseen = ALPHABET - int(levels[0].different.sum())
    out[open_] -= np.log10(max(unseen, 1))
    return out


def pair_counts(docs: DataFrame) -> np.ndarray:
    """Counts of a byte after a byte in the rows, 256 x 256; the driver sums one row per byte and task slice."""

    def run(batches):  # noqa: ANN001, ANN202
        sums = np.zeros(1 << 16, np.int64)
        for batch in batches:
            data = np.frombuffer(bytes([END]) + b"".join(canonical(batch.column(0).cast(pa.binary()).to_pylist())), np.uint8)
            sums += np.bincount((data[:-1].astype(np.uint16) << 8) | data[1:], minlength=1 << 16)
        rows = sums.reshape(256, 256)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(rows[used].tolist(), pa.list_(pa.int64()))], names=["first", "counts"]
        )

    def add(key: tuple[pa.Scalar, ...], batches):  # noqa: ANN001, ANN202
        total = sum((batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, 256).sum(axis=0) for batch in batches), np.zeros(256, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["first", "counts"])

    from collections.abc import Iterator

    add.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    schema = "first int, counts array<long>"
    out = np.zeros((256, 256), np.int64)
    for row in docs.select("text").mapInArrow(run, schema).groupBy("first").applyInArrow(add, schema).collect():
        out[row["first"]] = row["counts"]
    return out


def scored(docs: DataFrame, train: Column, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, trained, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``train`` says which rows are learned from. A null or blank text is the end mark alone. Rows that
    agree in doc_id are rows of their own; without training rows all bytes are alike. An empty table
    gives an empty result; other columns are not read.
    """
    picked = docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("trained"))
    size = packed.text_bytes(picked)
    # token buckets first, by ranges of hashes; then those of contexts
    token_buckets, context_buckets = packed.bucket_count(size) // 2, 2 * packed.LEAST_BUCKETS + size // (4 << 20)
    blocks = packed.with_blocks(picked, size, block_bytes)
    pairs = docs.sparkSession.sparkContext.broadcast(pair_counts(picked.where("trained")))
    width = order + 1

    def tokens_of(texts: list[bytes | None]) -> tuple[Block, np.ndarray, np.ndarray]:
        block = Block(texts, lower=True)
        keys, place = np.unique(np.concatenate([[END_KEY], block.words()]), return_inverse=True)
        return block, keys, place[1:]

    def in_buckets(grams: Grams) -> tuple[np.ndarray, np.ndarray]:
        bucket = gram_buckets(grams.codes, context_buckets)
        order_ = np.argsort(bucket, kind="stable")
        return bucket, order_

    def send(table: pa.Table) -> pa.Table:
        texts, wanted = packed.texts_of(table), table["trained"].to_numpy()
        number = table["block"][0].as_py()
        block, keys, place = tokens_of(texts)
        seen = np.bincount(place[wanted[block.owner]], minlength=len(keys))
        seen[keys == END_KEY] += int(wanted.sum())
        rows = [packed.sendings(number, keys, token_buckets, ["key", "seen"], [keys, seen.astype("<u4")])]
        del block, place
        grams = Grams(texts, order)
        bucket, by = in_buckets(grams)
        codes, seen = grams.codes[by].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width], grams.counts(wanted)[by].astype("<u4")
        full, begins = np.unique(bucket[by], return_index=True)
        for one, part in zip(full.tolist(), np.split(np.arange(len(by)), begins[1:]), strict=True):
            rows.append(
                pa.RecordBatch.from_arrays(
                    [pa.array([token_buckets + one], pa.int32()), pa.array([number], pa.int32()), pa.array([codes[part].tobytes()]), pa.array([seen[part].tobytes()])],
                    names=["bucket", "block", "key", "seen"],
                )
            )
        return pa.Table.from_batches(rows)

    def answer(table: pa.Table) -> pa.Table:
        bucket, senders = table["bucket"][0].as_py(), table["block"].to_pylist()
        seen = np.concatenate(packed.unpacked(table["seen"], "<u4"))
        if bucket < token_buckets:
            parts = packed.unpacked(table["key"], "<u8")
            keys, place = np.unique(np.concatenate(parts), return_inverse=True)
            totals = np.bincount(place, weights=seen, minlength=len(keys)).astype("<i8")
            values = totals[place]
            senders, extra = [*senders, TOTALS], [np.array([(totals > 0).sum()], "<i8")]
        else:
            parts = [value.reshape(-1, width) for value in packed.unpacked(table["key"], "u1")]
            wide = np.zeros((sum(map(len, parts)), 8), np.uint8)
            wide[:, :width] = np.concatenate(parts)
            keys, place = np.unique(wide.view("<u8").ravel(), return_inverse=True)
            counts = np.bincount(place, weights=seen, minlength=len(keys)).astype(np.int64)
            values, extra = log_probabilities(keys, counts, pairs.value, order).astype("<f4")[place], []
        answers = [*np.split(values, np.cumsum([len(part) for part in parts])[:-1]), *extra]
        return pa.table(
            {
                "block": pa.array(senders, pa.int32()),
                "bucket": pa.array([bucket] * len(senders), pa.int32()),
                "answer": pa.array([part.tobytes() for part in answers], pa.binary()),
            }
        )

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            different = sum(int(part[0]) for part in packed.unpacked(answers["answer"], "<i8"))
            return pa.Table.from_pylist([{"different": different}], schema=no_rows.schema)
        answers = answers.sort_by("bucket")
        of_tokens = pa.compute.less(answers["bucket"], token_buckets)
        texts = packed.texts_of(table)
        block, keys, place = tokens_of(texts)
        counts = np.concatenate(packed.unpacked(answers.filter(of_tokens)["answer"], "<i8"))
        end = int(counts[np.searchsorted(keys, END_KEY)])
        logs = np.bincount(block.owner, weights=np.log10(counts[place] + 1), minlength=len(texts)) + np.log10(end + 1)
        known = np.bincount(block.owner, weights=counts[place] > 0, minlength=len(texts)).astype(np.int64) + (end > 0)
        n_tokens = np.diff(block.bounds) + 1
        del block, place
        grams = Grams(texts, order)
        values = np.empty(len(grams.codes))
        values[in_buckets(grams)[1]] = np.concatenate(packed.unpacked(answers.filter(pa.compute.invert(of_tokens))["answer"], "<f4"))
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "trained": table["trained"],
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "logs": pa.array(logs, pa.float64()),
                "score": pa.array(grams.sums(values), pa.float64()),
                "different": pa.nulls(len(texts), pa.int64()),
            }
        )

    id_type = picked.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, trained boolean, n_tokens long, n_known long, logs double, score double, different long"
    no_rows = packed.nothing(schema)
    sent = blocks.groupBy("block").applyInArrow(send, "bucket int, block int, key binary, seen binary")
    answers = sent.groupBy("bucket").applyInArrow(answer, "block int, bucket int, answer binary")
    rows = cut(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema))
    different, tokens = rows.agg(
        F.coalesce(F.sum("different"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("trained"), F.col("n_tokens"))), F.lit(0))
    ).first()
    return rows.where(F.col("different").isNull()).select(
        "doc_id",
        "trained",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(tokens + different + 1)))).alias("base_score"),
        "score",
    )
