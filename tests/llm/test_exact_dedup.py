import hashlib
import re
from collections import defaultdict

import numpy as np

from tallyweek.llm import exact_dedup


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[fold(row.text)].append(row.doc_id)
    return groups


def check(docs, counters):
    groups = expected(docs.collect())
    out = exact_dedup.decisions(docs, counters).collect()
    assert len(out) == sum(map(len, groups.values()))
    by_digest = {hashlib.sha256(text.encode()).digest(): ids for text, ids in groups.items()}
    kept = defaultdict(int)
    for row in out:
        ids = by_digest[bytes(row.digest)]
        known = [i for i in ids if i is not None]
        assert row.keep_id == (max(known) if known else None) and row.group_size == len(ids)
        kept[bytes(row.digest)] += row.kept
        assert not row.kept or row.doc_id == row.keep_id
    assert set(kept.values()) <= {1}


def test_odd(odd_docs):
    check(odd_docs, 1024)
    check(odd_docs, 3)


def test_copies_with_and_without_heavy_path(some_docs):
    check(some_docs, 8)
    check(some_docs, 1024)


def test_empty(no_docs):
    assert exact_dedup.decisions(no_docs).count() == 0
    assert exact_dedup.drop_copies(no_docs).count() == 0


def test_rows_that_stay(odd_docs, some_docs):
    for docs in (odd_docs, some_docs):
        for counters in (4, 1024):
            out = exact_dedup.drop_copies(docs, counters)
            assert out.columns == docs.columns
            stays = {text: max((i for i in ids if i is not None), default=None) for text, ids in expected(docs.collect()).items()}
            assert sorted((fold(r.text), repr(r.doc_id)) for r in out.collect()) == sorted((t, repr(i)) for t, i in stays.items())


def test_misra_gries_keeps_frequent_keys():
    draw = np.random.default_rng(0)
    keys = np.concatenate([np.full(4000, b"hot", "S32"), draw.integers(0, 5000, 6000).astype("S32")])
    draw.shuffle(keys)
    summary = np.empty(0, "S32"), np.empty(0, np.int64)
    for part in np.array_split(keys, 17):
        summary = exact_dedup.misra_gries(np.concatenate([summary[0], part]), np.concatenate([summary[1], np.ones(len(part), np.int64)]), 20)
        assert len(summary[0]) <= 20
    found = dict(zip(summary[0].tolist(), summary[1].tolist()))
    assert 4000 - 10_000 // 21 <= found[b"hot"] <= 4000


def test_hot_group_is_settled_by_broadcast(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'Same' ELSE 'own ' || id END AS text")
    rows, heavy = exact_dedup._split(docs, 64)
    (winner,) = heavy.collect()
    assert winner.winner.doc_id == 2997 and winner.group_size == 1000
