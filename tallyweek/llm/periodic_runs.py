"""Periodic runs of words by internal pattern matching.

A run is a stretch of consecutive words with smallest period q, at least ``least`` words
and four periods long, that no neighbouring word extends keeping the period. Such a run
holds a whole block of m = 2^k words, aligned to m, and the block's copy q words later,
for the one m with (2m - 1) / 3 <= q <= (4m - 2) / 3. So for every aligned block the
occurrences in the neighbouring window at those distances are asked of a suffix array:
they are a range of it, and a wavelet tree over the array finds the range's successor of
a position. Starts in so short a window form one arithmetic progression. One or two give
their distances as candidate periods; a longer one has the block's own period, and the
candidates are the shifts that lay the two stretches with that period on each other.
A candidate is extended to both sides by comparing ranks of blocks of 2^k words.

What cannot be in a run is left out first: in a run every three consecutive words occur
at least three times. The rest of several documents is worked on at once, with words that
occur nowhere else between the stretches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Periods in a run, and its smallest number of words.
TIMES = 4
LEAST = 6
#: Words that are searched at once; a document with more is searched by itself.
TOGETHER = 200_000
#: Bytes of text worked on at once.
BATCH_BYTES = 8 << 20
#: Rounds of leaving out what cannot be in a run; more only cost time.
ROUNDS = 8


class WaveletTree:
    """Counts and selects by value within ranges of an array of 0 to n - 1, one level per bit."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        left = values
        for bit in range(self.bits - 1, -1, -1):
            zero = (left >> bit) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero)]).astype(np.int32))
            left = np.concatenate([left[zero], left[~zero]])

    def below(self, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many of the range's values are below ``value``."""
        found = np.zeros(len(start), np.int64)
        over, value = value >= 1 << self.bits, np.maximum(value, 0)
        s, e = start.astype(np.int64), end.astype(np.int64)
        for level, zeros in enumerate(self.zeros):
            one = (value >> (self.bits - 1 - level)) & 1 == 1
            zs, ze = zeros[s].astype(np.int64), zeros[e].astype(np.int64)
            found += np.where(one, ze - zs, 0)
            s, e = np.where(one, zeros[-1] + s - zs, zs), np.where(one, zeros[-1] + e - ze, ze)
        return np.where(over, end - start, found)

    def select(self, start: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The range's k-th smallest value, from 0."""
        s, e, k = start.astype(np.int64), end.astype(np.int64), k.astype(np.int64)
        value = np.zeros(len(s), np.int64)
        for level, zeros in enumerate(self.zeros):
            zs, ze = zeros[s].astype(np.int64), zeros[e].astype(np.int64)
            one = k >= ze - zs
            value = 2 * value + one
            k = np.where(one, k - (ze - zs), k)
            s, e = np.where(one, zeros[-1] + s - zs, zs), np.where(one, zeros[-1] + e - ze, ze)
        return value


class Blocks:
    """Suffix array of a sequence, and ranks of all its blocks of 2^k elements.

    ``ranks[k][i]`` is the number of suffixes whose first 2^k elements come before those at i; what goes
    beyond the end compares as less. Equal ranks are equal blocks.
    """

    def __init__(self, sequence: np.ndarray, longest: int) -> None:
        n = len(sequence)
        _, inverse, counts = np.unique(sequence, return_inverse=True, return_counts=True)
        rank = (np.cumsum(counts) - counts)[inverse]
        self.n, self.ranks = n, [rank.astype(np.int32)]
        order, h = np.argsort(rank, kind="stable"), 1
        while h <= longest or len(self.ranks) < 2:
            after = np.zeros(n, np.int64)
            after[: max(n - h, 0)] = rank[h:] + 1
            key = rank.astype(np.int64) * (n + 1) + after
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[True], np.diff(key[order]) != 0])
            rank = np.empty(n, np.int64)
            rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            self.ranks.append(rank.astype(np.int32))
            h *= 2
        self.suffixes = order

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many elements agree from i and from j on; i < j."""
        at = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[k]
            inside = j + at < self.n
            here = np.where(inside, j + at, 0)
            same = inside & (rank[np.where(inside, i + at, 0)] == rank[here])
            at += np.where(same, 1 << k, 0)
        return at

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many elements agree before i and before j; i < j."""
        at = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, step = self.ranks[k], at + (1 << k)
            inside = i - step >= 0
            same = inside & (rank[np.where(inside, i - step, 0)] == rank[np.where(inside, j - step, 0)])
            at = np.where(same, step, at)
        return at

    def stretch(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the longest stretch around [at, at + period) that keeps the period."""
        return at - self.back(at, at + period), at + period + self.ahead(at, at + period)


def _candidates(blocks: Blocks, tree: WaveletTree, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Aligned blocks of 2^k elements and candidate periods from their occurrences in the neighbouring window."""
    m = 1 << k
    nearest, farthest = -(-(2 * m - 1) // 3), (4 * m - 2) // 3
    rank = blocks.ranks[k]
    size = np.bincount(rank, minlength=blocks.n)
    at = np.arange(0, blocks.n - m + 1, m)
    at = at[size[rank[at]] > 1]
    start = rank[at].astype(np.int64)
    end = start + size[start]
    before, until = tree.below(start, end, at + nearest), tree.below(start, end, at + farthest + 1)
    count = until - before

    def occurrence(which: np.ndarray, number: int) -> np.ndarray:
        return tree.select(start[which], end[which], before[which] + number)

    some, more, many = (np.flatnonzero(count >= least) for least in (1, 2, 3))
    one, two = occurrence(some, 0), occurrence(more, 1)
    found = [(at[some], one - at[some]), (at[more], two - at[more])]
    if len(many):
        # the block repeats itself: the stretch of its own period here, and the one of its copies
        here, first = at[many], one[count[some] >= 3]
        own = two[count[more] >= 3] - first
        s1, e1 = blocks.stretch(here, own)
        s2, e2 = blocks.stretch(first, own)
        for period in (s2 - s1, e2 - e1):
            fits = (period >= nearest) & (period <= farthest)
            found.append((here[fits], period[fits]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs_of(sequence: np.ndarray, longest: int, times: int = TIMES, least: int = LEAST) -> np.ndarray:
    """(start, length, period) of every run, sorted by start, then period; ``longest`` bounds a run's length.

    ``times`` must be 4 or more, so that each run holds an aligned block and its copy.
    """
    n = len(sequence)
    if n < least:
        return np.empty((0, 3), np.int64)
    blocks = Blocks(sequence, longest)
    tree = WaveletTree(blocks.suffixes)
    found = []
    k = 1
    while k < len(blocks.ranks) and (2 << k) - 1 <= 3 * (longest // times) and 1 << k <= n:
        at, period = _candidates(blocks, tree, k)
        inside = at + period < n
        at, period = at[inside], period[inside]
        start, end = blocks.stretch(at, period)
        enough = end - start >= np.maximum(least, times * period)
        found.append(np.stack([start, end - start, period], axis=1)[enough])
        k += 1
    if not found:
        return np.empty((0, 3), np.int64)
    rows = np.concatenate(found)
    # one stretch has one smallest period; its multiples are candidates as well
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.concatenate([[True], (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)])[: len(rows)]
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def repeating_parts(words: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches that may hold runs: every three words in a row occur three times in the stretch.

    Three words of a run of four periods and six words occur at least three times in it.
    """
    n = len(words)
    if n < LEAST:
        return []
    wide = np.int64(words.max()) + 1
    pairs = np.unique(words[:-1] * wide + words[1:], return_inverse=True)[1]
    triples = np.unique(pairs[:-1] * wide + words[2:], return_inverse=True)[1]
    kept = np.bincount(triples)[triples] >= 3
    for last in [False] * (ROUNDS - 1) + [True]:
        # number the stretches of kept triples, and count again within each
        edge = np.diff(np.concatenate([[0], kept.astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = ends - starts >= LEAST - 2
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return []
        at = np.concatenate([np.arange(s, e) for s, e in zip(starts, ends)])
        stretch = np.repeat(np.arange(len(starts)), ends - starts)
        key = np.unique(stretch * np.int64(len(triples) + 1) + triples[at], return_inverse=True)[1]
        often = np.bincount(key)[key] >= 3
        if last or often.all():
            return [(int(s), int(e) + 2) for s, e in zip(starts, ends)]
        kept = np.zeros(len(triples), bool)
        kept[at[often]] = True
    return []


def runs_of_all(documents: list[np.ndarray]) -> list[np.ndarray]:
    """The runs of several documents, each given as numbers that stand for its words."""
    parts: list[tuple[int, int, int]] = []
    for number, words in enumerate(documents):
        parts += [(number, start, end) for start, end in repeating_parts(words)]
    found: list[list[np.ndarray]] = [[] for _ in documents]
    group: list[tuple[int, int, int]] = []
    held = 0
    for part in [*parts, None]:
        if group and (part is None or held + part[2] - part[1] > TOGETHER):
            # between two parts stands a number that occurs once
            pieces = [piece for at, (d, s, e) in enumerate(group) for piece in (documents[d][s:e], [-1 - at])]
            firsts = np.cumsum([0, *(e - s + 1 for _, s, e in group)])
            runs = runs_of(np.concatenate(pieces).astype(np.int64), max(e - s for _, s, e in group))
            owner = np.searchsorted(firsts, runs[:, 0], side="right") - 1
            for at in np.unique(owner):
                d, s, _ = group[at]
                mine = runs[owner == at]
                mine[:, 0] += s - firsts[at]
                found[d].append(mine)
            group, held = [], 0
        if part is not None:
            group.append(part)
            held += part[2] - part[1] + 1
    return [np.concatenate(rows) if rows else np.empty((0, 3), np.int64) for rows in found]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words but those that a run has after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[at] for at in kept])


def _numbers(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal words having equal numbers."""
    known = {word: number for number, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of a batch with their texts' bytes, about BATCH_BYTES at a time."""
    texts: list[bytes] = []
    first = held = 0
    for row, text in enumerate(batch.column(1).cast(pa.binary())):
        texts.append(text.as_py() or b"")
        held += len(texts[-1])
        if held >= BATCH_BYTES or row == batch.num_rows - 1:
            yield batch.slice(first, row + 1 - first), texts
            texts, first, held = [], row + 1, 0


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs and collapsed of every row of doc_id and text.

    ``runs`` holds (start, length, period) of every run, by start, then period; words are numbered from 0.
    ``collapsed`` has the words without repetitions: a run keeps its first period only. A null text has no
    words, no runs and the empty text; repeated rows give repeated rows; other columns are not read. A row is
    searched by one task, in memory that grows with its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in _groups(batch):
                words = [text.split() for text in texts]
                runs = runs_of_all([_numbers(of_text) for of_text in words])
                flat = np.concatenate(runs)
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                entry = pa.StructArray.from_arrays([pa.array(flat[:, at]) for at in range(3)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.ListArray.from_arrays(ends, entry),
                        pa.array(map(collapsed, words, runs), pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "runs", "collapsed"],
                )

    picked = docs.select("doc_id", "text")
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(
        run, f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
