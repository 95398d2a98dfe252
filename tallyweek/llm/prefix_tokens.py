"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

The vocabulary is a sentencepiece model of the BPE kind. The last token of a prefix's
encoding decides the rest: what comes before it is the encoding of a shorter prefix. So
a prefix that ends at a character takes the longest token ending there that stays apart
from the last token of the prefix before it, and its count is that prefix's count plus
one. Two tokens stay apart if merging their joined text in the model's order keeps them
apart. Characters outside the vocabulary cost their UTF-8 bytes and join nothing.

No token goes on after a word's last character, so a prefix's count is the counts of the
words before plus an entry of its last word's own table. Tables of words are remembered.
The table of a text answers how many tokens a prefix has and how much of the text fits a
budget, without encoding again. Counts can fall as a prefix grows, since a longer prefix
may end in one long token.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words and pairs that a worker remembers.
REMEMBERED = 250_000
#: The prefixes of a longer word are not remembered.
LONGEST_REMEMBERED = 64
#: Prefixes in a row of the stored table.
BLOCK = 4096
#: Fixed value: what stands for a blank in the model.
BLANK = "▁"


class Remembered(dict):
    """Values of a function, found once; those not asked for again make room for others."""

    def __init__(self, find: Callable) -> None:
        super().__init__()
        self.find, self.before = find, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.find(key)
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        if len(key) <= LONGEST_REMEMBERED:
            self[key] = value
        return value


class Pieces:
    """A model's tokens with their ranks, and tables of words."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as described

        model = described.ModelProto()
        model.ParseFromString(Path(path).read_bytes())
        kinds = described.ModelProto.SentencePiece
        norm, trained = model.normalizer_spec, model.trainer_spec
        supported = (
            trained.model_type == described.TrainerSpec.BPE
            and trained.byte_fallback
            and not trained.treat_whitespace_as_suffix
            and not norm.precompiled_charsmap
            and not norm.remove_extra_whitespaces
            and norm.escape_whitespaces
            and not any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)
        )
        found = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        if not supported or any(re.search(f"[^{BLANK}]{BLANK}", piece) for piece in found):
            raise ValueError(f"{path}: not a BPE model with byte fallback, unchanged characters and tokens within words")
        self.start = BLANK if norm.add_dummy_prefix else ""
        self.single = {piece for piece in found if len(piece) == 1}
        place = {score: at for at, score in enumerate(sorted(set(found.values()), reverse=True), 1)}
        #: place in the order of merges of every token that a merge makes; equal scores merge from left to right.
        self.rank = {piece: place[score] for piece, score in found.items() if len(piece) > 1}
        #: the last merge of each token that the merges do reach.
        self.split = {piece: halves for piece in self.rank if (halves := self._last_merge(piece))}
        automaton = ahocorasick.Automaton()
        for piece in self.split:
            automaton.add_word(piece, piece)
        automaton.make_automaton()
        self.endings = automaton.iter if self.split else lambda word: ()
        joining = "".join(sorted({c for piece in self.split for c in piece} - {BLANK}))
        inside = f"[{re.escape(joining)}]" if joining else "(?!)"
        # blanks and a word, or a character that no token joins with another
        self.words = re.compile(f"{BLANK}+{inside}*|{inside}+|.", re.DOTALL).findall
        self.apart = Remembered(self._stay_apart)
        self.totals = Remembered(lambda word: self._count(word)[-1])
        self.tables = Remembered(lambda word: array("q", self._count(word)[1:]))

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two tokens of a token's last merge; None if merging its text gives something else."""
        parts = list(piece)
        while len(parts) > 2:
            ranks = [self.rank.get(a + b, 0) for a, b in zip(parts, parts[1:])]
            best = min((rank, at) for at, rank in enumerate(ranks) if rank) if any(ranks) else None
            if best is None:
                return None
            at = best[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts[0], parts[1]

    def _stay_apart(self, pair: tuple[str, str]) -> bool:
        """Whether the two tokens are two again when their joined text is encoded.

        The later of the merges next to the border is undone, step by step; a merge across the border
        that comes before the undone one would have joined the two. Of equal ranks the right one is later.
        """
        rank, (a, b), until = self.rank, pair, len(self.rank) + 2
        while True:
            if rank.get(a + b, until) < until:
                return False
            of_a, of_b = rank.get(a, 0), rank.get(b, 0)
            if not of_a and not of_b:
                return True
            if of_a > of_b:
                until, a = of_a, self.split[a][1]
            else:
                until, b = of_b + 1, self.split[b][0]

    def _count(self, word: str) -> list[int]:
        """Tokens of the word's prefixes of 0, 1, ... characters."""
        n, apart = len(word), self.apart
        last: list[str | None] = [None] * (n + 1)
        counts = [0] + [-1] * n
        done = 0
        # matches come by their end, the longest first
        for stop, token in self.endings(word):
            while done < stop:
                done += 1
                if counts[done] < 0:
                    self._one(word, done, last, counts)
            end = stop + 1
            if counts[end] < 0:
                start = end - len(token)
                before = last[start]
                if before is None or apart[before, token]:
                    last[end], counts[end] = token, counts[start] + 1
        for end in range(done + 1, n + 1):
            if counts[end] < 0:
                self._one(word, end, last, counts)
        return counts

    def _one(self, word: str, end: int, last: list[str | None], counts: list[int]) -> None:
        """A character that no longer token ends with: a token, or its bytes."""
        character = word[end - 1]
        if character in self.single:
            last[end], counts[end] = character, counts[end - 1] + 1
        else:
            counts[end] = counts[end - 1] + len(character.encode())

    def table(self, word: str) -> array:
        """Tokens of the word's prefixes of 1, 2, ... characters."""
        return self.tables[word] if len(word) <= LONGEST_REMEMBERED else array("q", self._count(word)[1:])

    def total(self, text: str) -> int:
        """Tokens of the whole text."""
        return sum(map(self.totals.__getitem__, self.words(self.start + text.replace(" ", BLANK)))) if text else 0

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of the prefixes of 0, 1, ... characters, the last being the whole text."""
        if not text:
            return np.zeros(1, np.int64)
        words = self.words(self.start + text.replace(" ", BLANK))
        tables = [np.frombuffer(self.table(word), np.int64) for word in words]
        starts = list(accumulate((int(table[-1]) for table in tables), initial=0))
        joined = np.concatenate([table + start for table, start in zip(tables, starts)])
        # the blank put before the text belongs to every prefix but the empty one
        return np.concatenate([np.zeros(1, np.int64), joined[len(self.start) :]])


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The model of a file, loaded once in a worker."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row: the last entry of its prefix table.

    A null text counts as empty and has 0 of both; repeated rows give repeated rows. ``path`` is the
    model's file, found under that path on every executor. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(path)
        for batch in batches:
            counts = [known.total(text.as_py() or "") for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    picked = docs.select("doc_id", n_bytes, "text")
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")


def prefix_table(docs: DataFrame, path: str, block: int = BLOCK) -> DataFrame:
    """The table to store: doc_id, text_key, first, counts.

    ``counts`` holds the tokens of the prefixes of ``first``, ``first`` + 1, ... characters, at most ``block``
    of them a row, so that no row grows with its text. Every document has the row of the empty prefix.
    ``text_key`` is the text's xxhash64 and keeps apart different texts under one doc_id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(path)
        for batch in batches:
            for row in range(batch.num_rows):
                counts = known.prefixes(batch.column(2)[row].as_py() or "")
                firsts = np.arange(0, len(counts), block)
                ends = np.append(firsts, len(counts)).astype(np.int32)
                same = pa.array(np.zeros(len(firsts), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, 1).take(same),
                        batch.column(1).slice(row, 1).take(same),
                        pa.array(firsts, pa.int64()),
                        pa.ListArray.from_arrays(ends, counts),
                    ],
                    names=["doc_id", "text_key", "first", "counts"],
                )

    picked = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, text_key long, first long, counts array<long>")


def fitting(table: DataFrame, budget: int) -> DataFrame:
    """doc_id, text_key, n_chars, n_tokens: the longest prefix of each text with at most ``budget`` tokens.

    Answered from the stored table alone. With a budget of 0 or less only the empty prefix can fit.
    """
    kept = F.filter(
        F.transform("counts", lambda count, at: F.struct((F.col("first") + at).alias("n_chars"), count.alias("n_tokens"))),
        lambda prefix: prefix["n_tokens"] <= F.lit(budget),
    )
    longest = table.select("doc_id", "text_key", F.array_max(kept).alias("fit"))
    return longest.groupBy("doc_id", "text_key").agg(F.max("fit").alias("fit")).select("doc_id", "text_key", "fit.*")


def tokens_at(table: DataFrame, wanted: DataFrame, block: int = BLOCK) -> DataFrame:
    """``wanted`` (doc_id, n_chars) with text_key and the tokens of that prefix; a prefix beyond the text has none.

    ``block`` is that of the table. A prefix finds its row by its number of characters, so a long text's
    questions meet only the rows that they ask for.
    """
    rows = table.select("doc_id", "text_key", "first", "counts").distinct()
    asked = wanted.withColumn("first", F.expr(f"n_chars div {int(block)} * {int(block)}"))
    found = asked.join(rows, ["doc_id", "first"])
    count = F.get("counts", (F.col("n_chars") - F.col("first")).cast("int"))
    return found.withColumn("n_tokens", count).drop("first", "counts")


def cut_to_budget(docs: DataFrame, table: DataFrame, budget: int) -> DataFrame:
    """The documents (all columns) with text cut to the longest prefix of at most ``budget`` tokens.

    What fits is read from the stored table. A null text stays null. Rows whose text is not in the table are lost,
    so the table must be of these documents.
    """
    packed = docs.select(F.struct("*").alias("row"))
    key = F.xxhash64(F.coalesce("row.text", F.lit(""))).alias("key")
    fits = fitting(table, budget).select(F.col("doc_id").alias("id"), F.col("text_key").alias("key_of"), "n_chars")
    joined = packed.select("row", key).join(fits, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("key_of")))
    cut = F.substring("row.text", F.lit(1), F.col("n_chars").cast("int"))
    return joined.select(*[cut.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
