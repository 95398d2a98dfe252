"""Periodic runs against brute force."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyweek.llm import periodic_runs
from tallyweek.llm.queries import QUERIES, planted_repetitions


def brute(words, times=4, least=6):
    """Every maximal stretch of every period; of equal stretches the smallest period."""
    n, best = len(words), {}
    for q in range(1, n // times + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end > start and end + q - start >= max(least, times * q):
                best.setdefault((start, end + q), q)
            start = end + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def found(words):
    numbers = periodic_runs._numbers([str(w).encode() for w in words])
    return [tuple(map(int, r)) for r in sorted(periodic_runs.runs_of_all([numbers])[0].tolist(), key=lambda r: (r[0], r[2]))]


def by_start(rows):
    return sorted(rows, key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=80))
def test_small_alphabets(words):
    assert found(words) == by_start(brute(words))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12)), max_size=8))
def test_repeated_blocks(parts):
    words = [w for block, times in parts for w in block * times]
    assert found(words) == by_start(brute(words))


def test_nested_periods():
    """Runs whose words are runs themselves: blocks repeat inside the block."""
    draw = random.Random(3)
    for _ in range(120):
        inner = [0] * draw.randrange(1, 12) + [1] * draw.randrange(0, 5) + [0] * draw.randrange(0, 9)
        middle = inner * draw.randrange(1, 7) + [2] * draw.randrange(0, 2)
        words = [9] * draw.randrange(3) + middle * draw.randrange(1, 7) + middle[: draw.randrange(len(middle) + 1)] + [0] * draw.randrange(5)
        assert found(words) == by_start(brute(words))


def test_all_periods():
    for q in range(1, 70):
        block = list(range(q))
        for before in (0, 1, q // 2 + 3):
            words = list(range(1000, 1000 + before)) + block * 4 + block[: q // 3] + [5000, 5001]
            expected = [(before, 4 * q + q // 3, q)] if 4 * q + q // 3 >= 6 else []
            assert found(words) == expected
            assert found(words[: before + 4 * q - 1]) == []


def test_many_documents_at_once(monkeypatch):
    draw = random.Random(8)
    docs = [np.array([draw.randrange(2) for _ in range(draw.randrange(60))] * draw.randrange(1, 6), np.int64) for _ in range(150)]
    expected = [by_start(brute(d.tolist())) for d in docs]
    for together in (1, 50, 10**6):
        monkeypatch.setattr(periodic_runs, "TOGETHER", together)
        runs = [by_start(map(tuple, r.tolist())) for r in periodic_runs.runs_of_all(docs)]
        assert runs == expected


def test_wavelet_tree():
    draw = np.random.default_rng(1)
    for n in (1, 2, 3, 8, 100, 257):
        values = draw.permutation(n)
        tree = periodic_runs.WaveletTree(values)
        start, end = np.sort(draw.integers(0, n + 1, (2, 200)), axis=0)
        value = draw.integers(-2, n + 3, 200)
        expected = [(values[s:e] < v).sum() for s, e, v in zip(start, end, value)]
        assert tree.below(start, end, value).tolist() == expected
        start, end = start[end > start], end[end > start]
        k = np.array([draw.integers(0, e - s) for s, e in zip(start, end)], np.int64)
        assert tree.select(start, end, k).tolist() == [sorted(values[s:e])[x] for s, e, x in zip(start, end, k)]


def test_long_texts():
    """A million words: one word, two levels of repetition, and text without any run."""
    for words, least in (
        (np.zeros(1_000_000, np.int64), 1),
        (np.tile(np.arange(250_000) % 977, 4), 1),
        (np.random.default_rng(2).integers(0, 50_000, 1_000_000), 0),
        (np.random.default_rng(2).integers(0, 2, 400_000), 1),
    ):
        start = time.perf_counter()
        runs = periodic_runs.runs_of_all([words.astype(np.int64)])[0]
        assert len(runs) >= least and time.perf_counter() - start < 60


def summary(doc_id, text):
    """The contract in plain Python."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = by_start(brute(words))
    dropped = {at for s, length, q in runs for at in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else None
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for at, w in enumerate(words) if at not in dropped).encode()).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    out = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, sf_dir).select(*COLUMNS).collect()}
    assert len(out) == len(docs)
    # brute force takes the square of the words, so the longest texts are left to the tests above
    compared = [r for r in docs if len(r.text or "") < 40_000]
    assert len(compared) > 0.9 * len(docs) and sum(out[r.doc_id][1] > 0 for r in compared) > 30
    for r in compared:
        assert out[r.doc_id] == summary(r.doc_id, r.text)


def test_odd_rows(odd_docs, no_docs):
    from tallyweek.llm import queries

    expected = [summary(r.doc_id, r.text) for r in odd_docs.collect()]
    out = [tuple(r) for r in queries.run_digests(planted_repetitions(odd_docs)).select(*COLUMNS).collect()]
    assert sorted(out, key=repr) == sorted(expected, key=repr)
    assert queries.run_digests(planted_repetitions(no_docs)).count() == 0
    assert periodic_runs.find_runs(no_docs).count() == 0
