"""Language identification by error-correcting output codes.

Each language has a codeword. For every bit a classifier on hashed byte n-grams
says how much more likely the text is under the languages with that bit set than
under the others. A text goes to the codeword with the smallest loss, summed over
the bits with the weight each bit earned in training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id

DIMENSIONS = 1 << 15
#: Up to so many languages all different bits are used; beyond, BITS random ones.
ALL_CODES_UP_TO = 6
BITS = 63
UNKNOWN = "und"
#: Bytes of text whose features are counted at once.
AT_ONCE = 1 << 20
LETTER = regex.compile(r"\p{L}")


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """A row of -1 and 1 for each class; no column splits nothing and no two rows are equal."""
    if classes <= 1:
        return np.ones((classes, 1), np.int8)
    if classes <= ALL_CODES_UP_TO:
        bits = [[(number >> at) & 1 for at in range(classes)] for number in range(1, 1 << (classes - 1))]
        return np.array(bits, np.int8).T * 2 - 1
    generator = np.random.default_rng(seed)
    best, apart = None, -1
    while best is None or apart < 1:
        for _ in range(16):
            code = generator.choice(np.array([-1, 1], np.int8), (classes, max(BITS, 4 * classes.bit_length())))
            code = code[:, abs(code.sum(axis=0)) < classes]
            same = code.astype(np.int32) @ code.T.astype(np.int32)
            least = int((code.shape[1] - (same - 2 * code.shape[1] * np.eye(classes, dtype=np.int32)).max()) // 2)
            if least > apart:
                best, apart = code, least
    return best


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of texts, the hashed n-grams of one to four bytes and the text that each belongs to."""
    at = 0
    while at < len(texts):
        blobs, size = [], 0
        while at < len(texts) and (not blobs or size < AT_ONCE):
            blobs.append(b" " + " ".join(texts[at].lower().split()).encode() + b" ")
            size += len(blobs[-1])
            at += 1
        data = np.frombuffer(b"".join(blobs), np.uint8).astype(np.uint32)
        owner = np.repeat(np.arange(at - len(blobs), at, dtype=np.int32), [len(blob) for blob in blobs])
        code, found, owners = data.copy(), [], []
        for n in (2, 3, 4):
            if len(data) < n:
                break
            code = (code[:-1] << np.uint32(8)) | data[n - 1 :]
            whole = owner[: len(code)] == owner[n - 1 :]
            hashed = (code ^ np.uint32(n * 0x01000193)) * np.uint32(0x9E3779B1)
            found.append((hashed >> np.uint32(32 - DIMENSIONS.bit_length() + 1))[whole])
            owners.append(owner[: len(code)][whole])
        yield (np.concatenate(found) if found else np.empty(0, np.uint32)), (np.concatenate(owners) if owners else np.empty(0, np.int32))


#: A language's counts travel in so many slices, so that a frequent one is summed by several tasks.
SLICES = 32


def language_counts(labelled: DataFrame) -> DataFrame:
    """lang, slice, counts (DIMENSIONS / SLICES of them) of all rows with a text and a language."""
    width = DIMENSIONS // SLICES
    names = ["lang", "slice", "counts"]

    def rows(lang: str, slices: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(slices), pa.string()),
                pa.array([at for at, _ in slices], pa.int32()),
                pa.array([counts.tolist() for _, counts in slices], pa.list_(pa.int64())),
            ],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for lang in set(langs):
                total = sums.setdefault(lang, np.zeros(DIMENSIONS, np.int64))
                for found, _ in features([text for text, own in zip(texts, langs, strict=True) if own == lang]):
                    total += np.bincount(found, minlength=DIMENSIONS)
        for lang, total in sums.items():
            yield rows(lang, list(enumerate(total.reshape(SLICES, width))))

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width).sum(axis=0)
        yield rows(key[0].as_py(), [(key[1].as_py(), total)])

    schema = "lang string, slice int, counts array<long>"
    picked = labelled.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    return picked.mapInArrow(run, schema).groupBy("lang", "slice").applyInArrow(add, schema)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bit_weights: np.ndarray

    def margins(self, texts: list[str]) -> np.ndarray:
        """A row of bit margins for each text, between about -1 and 1."""
        sums, counts = np.zeros((len(texts), self.weights.shape[1])), np.zeros(len(texts))
        for found, owner in features(texts):
            order = np.flatnonzero(np.diff(owner, prepend=-1)) if len(owner) else np.empty(0, np.int64)
            if len(order):
                np.add.at(sums, owner[order], np.add.reduceat(self.weights[found], order, axis=0))
            counts += np.bincount(owner, minlength=len(texts))
        return np.tanh(2 * sums / np.maximum(counts, 1)[:, None])

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighted exponential loss of each language for each text."""
        agree = margins[:, None, :] * self.code[None, :, :]
        return (np.exp(-agree) * self.bit_weights).sum(axis=2)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (0 to 1) and whether the two best are hard to tell apart."""
        named = [text if text is not None and LETTER.search(text) else None for text in texts]
        known = [at for at, text in enumerate(named) if text is not None]
        out, scores, unclear = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        if not known or not self.languages:
            return out, scores, unclear
        losses = self.losses(self.margins([named[at] for at in known]))
        ranked = np.sort(losses, axis=1)
        chance = np.exp(-8 * (losses - ranked[:, :1]) / self.bit_weights.sum())
        top = losses.argmin(axis=1)
        scores[known] = 1 / chance.sum(axis=1)
        if len(self.languages) > 1:
            unclear[known] = (ranked[:, 1] - ranked[:, 0]) < 0.05 * self.bit_weights.sum()
        for at, language in zip(known, top.tolist(), strict=True):
            out[at] = self.languages[language]
        return out, scores, unclear


def fit(labelled: DataFrame) -> Model:
    """Learn from columns text and lang of all rows; rows with a null in either are left out.

    The driver gets one vector of DIMENSIONS counts per language.
    """
    sums: dict[str, np.ndarray] = {}
    for row in language_counts(labelled).collect():
        sums.setdefault(row.lang, np.zeros((SLICES, DIMENSIONS // SLICES), np.int64))[row.slice] = row.counts
    rows = [(lang, counts.ravel()) for lang, counts in sorted(sums.items()) if counts.any()]
    languages, code = [lang for lang, _ in rows], codewords(len(rows))
    if not languages:
        return Model([], code, np.zeros((DIMENSIONS, 1), np.float32), np.ones(1))
    counts = np.stack([counts for _, counts in rows])
    chances = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * DIMENSIONS)  # every language weighs the same
    weights, bit_weights = np.zeros((DIMENSIONS, code.shape[1]), np.float32), np.ones(code.shape[1])
    if len(languages) > 1:
        for bit in range(code.shape[1]):
            one, other = chances[code[:, bit] > 0].mean(axis=0), chances[code[:, bit] < 0].mean(axis=0)
            weights[:, bit] = np.log(one / other)
            # what a text of each language gets on average, on the right side of the border
            means = (chances * weights[:, bit]).sum(axis=1) * code[:, bit]
            bit_weights[bit] = max(0.05, float(np.tanh(2 * means).min()))
    return Model(languages, code, weights, bit_weights)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every row; only the whole text is looked at.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS x bits floats and the codewords

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, unclear = [], [], []
            for at in range(0, batch.num_rows, 256):
                part = shared.value.predict(batch.column(1).slice(at, 256).to_pylist())
                langs += part[0]
                scores.append(part[1])
                unclear.append(part[2])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64()), pa.array(np.concatenate(unclear) if unclear else [], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "ambiguous"],
            )

    picked = docs.select("doc_id", "text")
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, ambiguous boolean")


def held_out(docs: DataFrame, folds: int = 4, fold: int = 2):  # noqa: ANN201
    return crc_of_id(docs["doc_id"]) % folds == fold


def identify_all(docs: DataFrame) -> DataFrame:
    """Learn from the rows outside the held-out fold and predict all; adds held_out."""
    model = fit(docs.where(~held_out(docs)))
    found = identify(docs, model)
    return found.withColumn("held_out", held_out(found))
