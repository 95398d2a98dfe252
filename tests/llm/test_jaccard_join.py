import random
import re
from itertools import combinations

import numpy as np
import pytest

from tallyweek.llm import graph, jaccard_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[at : at + width]) for at in range(len(words) - width + 1))


def groups(rows, width, percent):
    sets = [shingles(r.text, width) for r in rows]
    root = list(range(len(rows)))

    def find(at):
        while root[at] != at:
            at = root[at]
        return at

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    return sets, [find(at) if sets[at] else None for at in range(len(rows))]


def check(docs, width=4, percent=85, **how):
    rows = docs.collect()
    sets, roots = groups(rows, width, percent)
    least = {}
    for row, root in zip(rows, roots):
        if root is not None and row.doc_id is not None:
            least[root] = min(least.get(root, row.doc_id), row.doc_id)
    expected = [(r.doc_id, len(s), least.get(root) if s else r.doc_id) for r, s, root in zip(rows, sets, roots)]
    out = jaccard_join.linked_groups(docs, width, percent, **how).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=repr) == sorted(expected, key=repr)
    return roots


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80), (2, 60)])
def test_against_brute_force(some_docs, width, percent):
    check(some_docs, width, percent)
    check(some_docs, width, percent, block_bytes=2000)


def test_odd(odd_docs, no_docs):
    check(odd_docs)
    assert jaccard_join.linked_groups(no_docs).count() == 0
    assert jaccard_join.one_of_each(no_docs).count() == 0


@pytest.fixture(scope="module")
def crowd(spark):
    """Near copies of one text, around the threshold, more than fit in one chunk, and a passage in all."""
    draw = random.Random(6)
    base = [f"b{n}" for n in range(100)]
    rows = []
    for number in range(150):
        words = list(base)
        for _ in range(draw.randrange(0, 4)):
            words[draw.randrange(100)] = f"x{number}"
        rows.append((number * 7 % 150, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_many_near_copies_in_chunks(crowd, monkeypatch):
    monkeypatch.setattr(jaccard_join.links, "__defaults__", (4, 16))
    roots = check(crowd)
    assert 1 < len(set(roots)) < 150


def test_one_of_each_group_stays(some_docs, odd_docs, crowd):
    for docs in (some_docs, odd_docs, crowd):
        rows = docs.collect()
        _, roots = groups(rows, 5, 80)
        best = {}
        for row, root in zip(rows, roots):
            if root is not None:
                key = (row.doc_id is None, row.doc_id)
                best[root] = min(best.get(root, key), key)
        out = jaccard_join.one_of_each(docs, 5, 80)
        assert out.columns == docs.columns
        loose = [(r.doc_id is None, r.doc_id) for r, root in zip(rows, roots) if root is None]
        assert sorted(map(repr, [*best.values(), *loose])) == sorted(repr((r.doc_id is None, r.doc_id)) for r in out.collect())


def test_partial_overlaps_sum_up():
    draw = np.random.default_rng(0)
    sets = [np.unique(draw.integers(0, 60, 40)).astype("<u8") for _ in range(30)]
    sizes = np.array([len(s) for s in sets])
    total = {}
    for low, high in ((0, 20), (20, 45), (45, 60)):
        part = [s[(s >= low) & (s < high)] for s in sets]
        for i, j, count in zip(*jaccard_join.partial_overlaps(part, sizes, 0, 50)):
            total[i, j] = total.get((i, j), 0) + count
    for i, j in combinations(range(30), 2):
        common = len(np.intersect1d(sets[i], sets[j]))
        linked = 100 * common >= 50 * (sizes[i] + sizes[j] - common)
        found = total.get((i, j), 0)
        assert linked == (100 * found >= 50 * (sizes[i] + sizes[j] - found))
        assert not linked or found == common


@pytest.mark.parametrize("per_task", [7, 1 << 20])
def test_components(spark, monkeypatch, per_task):
    monkeypatch.setattr(graph, "EDGES_PER_TASK", per_task)
    draw = random.Random(9)
    edges = [(a, a + 1) for a in range(1, 60)] + [(1000, 1000 + n) for n in range(1, 80)] + [(draw.randrange(2000, 2100), draw.randrange(2000, 2100)) for _ in range(70)]
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    out = graph.components(spark.createDataFrame(edges, "low long, high long").repartition(5))
    assert {(r.node, r.root) for r in out.collect()} == {(a, find(a)) for a in root if find(a) != a}
    assert graph.components(spark.createDataFrame([], "low long, high long")).count() == 0


def test_forest():
    low, high = graph.forest(np.array([3, 5, 9, 1]), np.array([5, 7, 9, 2]))
    assert sorted(zip(low.tolist(), high.tolist())) == [(1, 2), (3, 5), (3, 7)]
