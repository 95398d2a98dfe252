"""Rabin-Karp hashes of words and of word windows over whole byte blocks.

A prefix sum of ``value * base ** place`` (modulo 2 ** 64, base odd) gives the
hash of any span by one subtraction and one multiplication by the inverse power.
"""

from __future__ import annotations

import functools

import numpy as np

#: Places hashed at once; longer stretches are cut between spans.
STRETCH = 1 << 20
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_MASK = (1 << 64) - 1


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@functools.cache
def _powers(base: int, inverse: bool, count: int) -> np.ndarray:
    factor = pow(base, -1, 1 << 64) if inverse else base
    out = np.ones(count, np.uint64)
    done = 1
    while done < count:  # doubles what is known
        step = min(done, count - done)
        out[done : done + step] = out[:step] * np.uint64(pow(factor, done, 1 << 64))
        done += step
    return out


@functools.cache
def _byte_values(base: int) -> np.ndarray:
    return mixed((np.arange(1, 257, dtype=np.uint64)) * np.uint64(base))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:end]`` of each span; starts and ends ascend.

    ``values`` are bytes or 64-bit words.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, first + STRETCH, "right")))
        last = int(ends[to - 1])
        part = values[first:last]
        if part.dtype == np.uint8:
            part = _byte_values(base)[part]
        room = 1 << max(20, (last - first).bit_length())
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(part * _powers(base, False, room)[: last - first], out=sums[1:])
        low, high = starts[at:to] - first, ends[at:to] - first
        out[at:to] = (sums[high] - sums[low]) * _powers(base, True, room)[low]
        at = to
    return mixed(out ^ ((ends - starts).astype(np.uint64) * np.uint64(base)))


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Block:
    """The words of some texts: bounds in ``data``, and the number of words before each text."""

    def __init__(self, texts: list[bytes | None], lower: bool = False) -> None:
        joined = b"\n".join([text or b"" for text in texts]) + b"\n"
        self.data = np.frombuffer(joined, np.uint8)
        if lower:
            self.data = _LOWER[self.data]
        self.blank = _BLANK[self.data]
        edge = np.flatnonzero(np.diff(self.blank, prepend=True))
        self.starts, self.ends = edge[::2], edge[1::2]
        lengths = np.array([len(text or b"") + 1 for text in texts], np.int64)
        self.text_ends = np.cumsum(lengths)
        self.bounds = np.concatenate([[0], np.searchsorted(self.starts, self.text_ends)]).astype(np.int64)
        #: The text of each word.
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.bounds))

    def words(self, base: int = BASES[0]) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, base)

    def windows(self, words: np.ndarray, width: int, base: int = BASES[0]) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each window of ``width`` words within one text."""
        if len(words) < width:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        first = np.flatnonzero(self.owner[: len(words) - width + 1] == self.owner[width - 1 :])
        return first, span_hashes(words, first, first + width, base)
