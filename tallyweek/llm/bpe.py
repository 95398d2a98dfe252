"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

An Aho-Corasick automaton finds the longest token that starts at each byte of a
piece in one pass. The encoder takes longest tokens from left to right and checks
each neighbouring pair: a pair is compatible if merging the two tokens' texts
together keeps both apart. If not, it goes on to the next shorter token, or back.
What it ends with is exactly what the merges in rank order give, and no position
is tried twice with one end. Decoding gathers the tokens' bytes by their offsets.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pieces, and pairs of tokens, that a worker remembers at most.
REMEMBERED = 250_000
#: Longer pieces are not remembered (characters).
LONGEST_REMEMBERED = 64
#: Rows that are worked on at once.
ROWS = 256

#: How byte-level vocabularies split a text into pieces.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_of_symbol() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves; the other bytes, in order, for the characters from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + at): b for at, b in enumerate(others)}


class Remembered(dict):
    """What ``make`` gives for the keys asked for last; it is made again for those that were forgotten.

    The keys in use and as many from before them are kept, ``REMEMBERED`` at most in all: when the first half is
    full it becomes the second, so whatever is asked for often stays.
    """

    def __init__(self, make: Callable) -> None:
        super().__init__()
        self.make = make
        self.before: dict = {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if not isinstance(key, str) or len(key) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED // 2:
                self.before = dict(self)
                self.clear()
            self[key] = value
        return value


class Vocabulary:
    """Tokens in order of rank: single bytes first, then a token for each merge."""

    def __init__(self, path: str) -> None:
        import ahocorasick

        described = json.loads(Path(path).read_text(encoding="utf-8"))
        model, of = described["model"], byte_of_symbol()
        raw = lambda token: bytes(of[symbol] for symbol in token)
        ids = {raw(token): number for token, number in model["vocab"].items() if all(symbol in of for symbol in token)}
        self.special = {entry["content"]: entry["id"] for entry in described.get("added_tokens", [])}
        merges = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
        self.tokens = [bytes([b]) for b in range(256)]
        # pairs are left * number of tokens + right, so no tuple is built to look one up
        self.many = 256 + len({raw(left) + raw(right) for left, right in merges})
        self.left, self.right = list(range(256)), list(range(256))
        rank = {token: at for at, token in enumerate(self.tokens)}
        self.merged: dict[int, int] = {}
        for left, right in merges:
            a, b = rank[raw(left)], rank[raw(right)]
            token = raw(left) + raw(right)
            if token in rank:  # a second way to a token never wins against the first
                continue
            rank[token] = self.merged[a * self.many + b] = len(self.tokens)
            self.tokens.append(token)
            self.left.append(a)
            self.right.append(b)
        self.ids = np.array([ids[token] for token in self.tokens], np.uint32)
        self.rank = rank
        self.lengths = [len(token) for token in self.tokens]
        self.shorter = [self._prefix(token) for token in self.tokens]
        self.coded = [int(number).to_bytes(4, "little") for number in self.ids]
        self.automaton = ahocorasick.Automaton()
        for at, token in enumerate(self.tokens):
            self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, at))
        self.automaton.make_automaton()
        known = {int(number): token for token, number in zip(self.tokens, self.ids, strict=True)}
        known |= {number: text.encode() for text, number in self.special.items()}
        blobs = [known.get(number, b"") for number in range(max(known) + 1)]
        self.offsets = np.cumsum([0, *map(len, blobs)])
        self.blob = np.frombuffer(b"".join(blobs), np.uint8)
        self.fits = Remembered(lambda pair: self.compatible(*divmod(pair, self.many)))
        self.pieces = Remembered(self.code)

    def _prefix(self, token: bytes) -> int:
        """The longest token that starts ``token`` and is shorter; -1 if there is none."""
        return next((self.rank[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.rank), -1)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their joined text is encoded.

        Undo the later of the two merges next to the border, step by step; a merge across the
        border that comes before the undone one would have joined them.
        """
        a, b, many, merged = left, right, self.many, self.merged.get
        # nothing with a rank from here on was merged yet
        until = many
        while True:
            if merged(a * many + b, many) < until:
                return False
            if a < 256 and b < 256:
                return True
            if a > b:
                until = a
                a = self.right[a]
            else:
                # merges of equal rank run from left to right, so the right one is undone first
                until = b + 1
                b = self.left[b]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ranks of the piece's tokens."""
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        size, lengths, fits, many = len(piece), self.lengths, self.fits, self.many
        # matches come in the order of their ends, so the last from a start is the longest
        longest = [0] * size
        for end, (before, token) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - before] = token
        out: list[int] = []
        at, token, dead = 0, longest[0], set()
        while at < size:
            while True:
                end = at + lengths[token]
                if end not in dead and (not out or fits[out[-1] * many + token]):
                    out.append(token)
                    at = end
                    token = longest[at] if at < size else -1
                    break
                shorter = self.shorter[token]
                if shorter >= 0:
                    token = shorter
                    continue
                # no token goes on from here: take the last one back and try a shorter one
                dead.add(at)
                token = out.pop()
                at -= lengths[token]
        return out

    def code(self, piece: str) -> bytes:
        """Ids of a piece's tokens, as little-endian 32-bit integers."""
        coded = self.coded
        return b"".join([coded[token] for token in self.encode_piece(piece.encode())])

    def encode_text(self, text: str, findall) -> bytes:
        """Ids of a text without special tokens, as little-endian 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, findall(text)))

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' bytes; unknown ids stand for nothing."""
        ids = ids[ids < len(self.offsets) - 1]
        starts, lengths = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.blob[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)].tobytes()


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, loaded once in a worker."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


class Coder:
    """Encodes and decodes whole texts with the vocabulary of a file."""

    def __init__(self, path: str) -> None:
        import regex

        self.vocabulary = vocabulary(path)
        self.findall = regex.compile(PIECES).findall
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def encode(self, text: str) -> np.ndarray:
        """Token ids; special tokens' strings become their ids."""
        encode, words = self.vocabulary.encode_text, self.vocabulary
        if self.special is None or not any(name in text for name in words.special):
            coded = encode(text, self.findall)
        else:
            parts = self.special.split(text)
            coded = b"".join(
                np.uint32(words.special[part]).astype("<u4").tobytes() if at % 2 else encode(part, self.findall)
                for at, part in enumerate(parts)
            )
        return np.frombuffer(coded, "<u4")

    def decode(self, ids: np.ndarray) -> str:
        return self.vocabulary.decode(ids.astype(np.int64)).decode("utf-8", errors="replace")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def encode(docs: DataFrame, path: str, verify: bool = False) -> DataFrame:
    """All columns but ``ids``, then ids (array<int>). A null text counts as empty and has no ids.

    ``path`` is the vocabulary's file, found under that path on every executor. With ``verify`` the ids
    are decoded as well, and ``round_trip`` says whether they give the text.
    """
    added = ["ids", "round_trip"] if verify else ["ids"]
    names = [name for name in docs.columns if name not in added]
    schema = docs.select(*[F.col(f"`{name}`") for name in names]).schema.add("ids", T.ArrayType(T.IntegerType()))
    schema = schema.add("round_trip", T.BooleanType()) if verify else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(path)
        for batch in _slices(batches):
            texts = [text or "" for text in batch.column(names.index("text")).to_pylist()]
            coded = [coder.encode(text) for text in texts]
            ends = np.cumsum([0, *map(len, coded)], dtype=np.int32)
            columns = [*batch.columns, pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, "<u4"), *coded]).astype(np.int32))]
            if verify:
                columns.append(pa.array([coder.decode(ids) == text for ids, text in zip(coded, texts, strict=True)], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    return docs.select(*[F.col(f"`{name}`") for name in names]).mapInArrow(run, schema)


def decode(coded: DataFrame, path: str) -> DataFrame:
    """All columns but ``decoded``, then decoded, the text of ``ids``; null ids give the empty text."""
    names = [name for name in coded.columns if name != "decoded"]
    schema = coded.select(*[F.col(f"`{name}`") for name in names]).schema.add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(path)
        for batch in _slices(batches):
            ids = batch.column(names.index("ids"))
            texts = [coder.decode(one.values.to_numpy(zero_copy_only=False)) if one.is_valid else "" for one in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    return coded.select(*[F.col(f"`{name}`") for name in names]).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, without moving ids or texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(path)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column(1):
                ids = coder.encode(text.as_py() or "")
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                of_text.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    picked = docs.select("doc_id", "text")
    schema = f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return picked.mapInArrow(run, schema)
