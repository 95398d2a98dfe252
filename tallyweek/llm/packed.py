"""Counting billions of hashes without a row for each.

Texts are grouped in blocks of some megabytes. A block sends its distinct hashes
to buckets, packed in one binary per bucket; a bucket counts what it got and
answers every block, packed again. A bucket is a range of hashes, so no bucket is
large however often one hash occurs, since a block sends it once.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
#: Bytes of text for each bucket; about 256 thousand windows.
BUCKET_BYTES = 3 << 19
#: Buckets that even a small input is dealt to.
LEAST_BUCKETS = 32
#: Bytes of a short fingerprint; within a bucket about one in a hundred is met by chance.
SHORT = 3


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def with_blocks(docs: DataFrame, size: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add ``block``: texts of about ``block_bytes`` share one, by the hash of doc_id and text."""
    blocks = max(1, -(-size // block_bytes))
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", F.crc32("text")), F.lit(blocks)).cast("int"))


def bucket_count(size: int) -> int:
    return LEAST_BUCKETS + size // BUCKET_BYTES


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range begins in ascending 64-bit keys."""
    borders = np.array([(at << 64) // buckets for at in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, borders), [len(keys)]])


def sendings(block: int, keys: np.ndarray, buckets: int, names: list[str], columns: Iterable[np.ndarray]) -> pa.RecordBatch:
    """bucket, block and the packed columns, cut where the ascending keys change bucket."""
    bounds = bucket_bounds(keys, buckets)
    full = np.flatnonzero(np.diff(bounds))
    arrays = [pa.array(full, pa.int32()), pa.array(np.full(len(full), block), pa.int32())]
    for column in columns:
        width = column.dtype.itemsize if column.ndim == 1 else column.shape[1]
        offsets = np.append(bounds[full], bounds[-1]).astype(np.int32) * width
        arrays.append(pa.Array.from_buffers(pa.binary(), len(full), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(column))]))
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "block", *names])


def unpacked(column: pa.ChunkedArray, dtype: str) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), dtype) for value in column]


def short(keys: np.ndarray) -> np.ndarray:
    """The lowest bytes of each key, a row of bytes each."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHORT]


def from_short(packed: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(packed) // SHORT, 4), np.uint8)
    wide[:, :SHORT] = packed.reshape(-1, SHORT)
    return wide.view("<u4").ravel()


def member(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ascending, values)
    return ascending[np.minimum(at, len(ascending) - 1)] == values


def answer_shared(table: pa.Table) -> pa.Table:
    """Of one bucket's short fingerprints, those that more than one block sent, for each block."""
    sent = [from_short(part) for part in unpacked(table["key"], "u1")]
    values, counts = np.unique(np.concatenate(sent), return_counts=True)
    shared = values[counts > 1]
    found = [part[member(part, shared)] for part in sent]
    kept = [at for at, part in enumerate(found) if len(part)]
    return pa.table(
        {
            "block": table["block"].take(pa.array(kept, pa.int64())),
            "bucket": table["bucket"].take(pa.array(kept, pa.int64())),
            "shared": pa.array([found[at].tobytes() for at in kept], pa.binary()),
        }
    )


ANSWER = "block int, bucket int, shared binary"


def maybe_shared(keys: np.ndarray, buckets: int, answers: pa.Table) -> np.ndarray:
    """Which of the ascending keys were answered; a few that were not may be among them."""
    bounds, low = bucket_bounds(keys, buckets), from_short(short(keys).ravel())
    out = np.zeros(len(keys), bool)
    for bucket, shared in zip(answers["bucket"].to_pylist(), unpacked(answers["shared"], "<u4"), strict=True):
        part = slice(bounds[bucket], bounds[bucket + 1])
        out[part] = member(low[part], np.sort(shared))
    return out


def nothing(ddl: str) -> pa.Table:
    """An empty Arrow table of a Spark schema; needs the session, so not for use in tasks."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl)).empty_table()


def texts_of(table: pa.Table) -> list[bytes | None]:
    return table["text"].cast(pa.binary()).to_pylist()
