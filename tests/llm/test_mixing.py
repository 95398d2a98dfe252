import re
from collections import defaultdict

import numpy as np
import pytest

from tallyweek.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return len(WORD.findall(text or ""))


def targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {name: weights[at % len(weights)] for at, name in enumerate(names)}
    total, out, left = sum(sizes.values()), {}, set(names)
    while left:
        level = (total - sum(out.values())) / sum(weight[n] for n in left)
        over = {n for n in left if weight[n] * level >= most * sizes[n]}
        if not over:
            return out | {n: weight[n] * level for n in left}
        out |= {n: most * sizes[n] for n in over}
        left -= over
    return out


def check(docs):
    rows = docs.collect()
    sizes = defaultdict(int)
    for row in rows:
        sizes[row.source] += words(row.text)
    wanted = targets(dict(sizes))
    lined, _ = mixing.mix(docs)
    source = {r.row_key: r.source for r in lined.collect()}
    out = mixing.taken_words(docs).collect()
    assert sorted(r["size"] for r in out) == sorted(words(r.text) for r in rows)
    assert len(source) == len(rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in out)
    assert sum(r.taken for r in out) == pytest.approx(sum(round(t) for t in wanted.values()), abs=len(wanted))
    by_target = defaultdict(int)
    for r in out:
        by_target[round(r.target, 6)] += r.taken
    for name, target in wanted.items():
        same = [n for n in wanted if abs(wanted[n] - target) < 1e-6]
        assert by_target[round(target, 6)] == pytest.approx(target * len(same), abs=len(same))
    assert sorted(map(repr, out)) == sorted(map(repr, mixing.taken_words(docs).collect()))


def test_targets_are_met(some_docs, odd_docs):
    check(some_docs)
    check(odd_docs)


def test_empty(no_docs, spark):
    assert mixing.taken_words(no_docs).count() == 0
    assert mixing.mixed_rows(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["size"], r.taken) for r in mixing.taken_words(blank).collect()] == [(0, 0), (0, 0)]
    assert mixing.mixed_rows(blank).count() == 0


def test_split_is_exact_and_depends_on_the_seed_only():
    quotas, room = np.array([50, 0, 7, 300, 43]), np.array([100, 100, 100, 100])
    out = mixing.split_quotas(quotas, room, [1])
    assert (out.sum(axis=1) == quotas).all() and (out.sum(axis=0) == room).all() and (out >= 0).all()
    assert (out == mixing.split_quotas(quotas, room, [1])).all()
    assert (out != mixing.split_quotas(quotas, room, [2])).any()


def test_split_draws_what_a_hypergeometric_law_says():
    quotas, room = np.array([30, 70]), np.array([50, 50])
    first = [mixing.split_quotas(quotas, room, [seed])[0, 0] for seed in range(400)]
    assert np.mean(first) == pytest.approx(15, abs=0.5)
    assert np.var(first) == pytest.approx(50 * 0.3 * 0.7 * 50 / 99, rel=0.35)


def test_shards_draw_disjoint_blocks(some_docs):
    lined, pieces = mixing.mix(some_docs, shards=5, block_words=16)
    found = pieces.collect()
    assert all(0 <= p.shard < 5 and 0 < p.words <= 16 for p in found)
    seen = set()
    for p in found:
        run = {(p.row_key, p.epoch, at) for at in range(p.from_word, p.from_word + p.words)}
        assert not run & seen
        seen |= run
    per_shard = defaultdict(int)
    for p in found:
        per_shard[p.shard] += p.words
    assert max(per_shard.values()) - min(per_shard.values()) < 0.1 * sum(per_shard.values())


def copies_of(docs, **how):
    lined, pieces = mixing.mix(docs, whole_documents=True, **how)
    found = {r.row_key: r for r in lined.collect()}
    return found, {(p.row_key, p.epoch) for p in pieces.collect()}


def test_rows_of_the_mix(some_docs, odd_docs):
    """A row for each copy, unchanged."""
    for docs in (some_docs, odd_docs):
        out = mixing.mixed_rows(docs)
        assert out.columns == docs.columns
        rows, (found, copies) = out.collect(), copies_of(docs)
        assert len(rows) == len(copies)
        assert sum(words(r.text) for r in rows) == sum(found[key]["size"] for key, _ in copies)
        given = {tuple(r) for r in docs.collect()}
        assert all(tuple(r) in given for r in rows)


def test_each_source_is_as_near_its_target_as_whole_documents_allow(spark):
    """Every choice of one copy more or not of each document, on top of the copies that all have."""
    docs = spark.range(150).selectExpr("id AS doc_id", "repeat('w\n', cast(3 + id * id % 90 AS int)) AS text", "'s' || id % 25 AS source")
    found, copies = copies_of(docs)
    sizes, taken = defaultdict(list), defaultdict(int)
    for r in found.values():
        sizes[r.source].append(r["size"])
    for key, _ in copies:
        taken[found[key].source] += found[key]["size"]
    for source, target in {r.source: r.target for r in found.values()}.items():
        own = sizes[source]
        all_have = round(target) // sum(own) * sum(own)
        choices = {all_have + sum(n for bit, n in enumerate(own) if chosen >> bit & 1) for chosen in range(1 << len(own))} - {0}
        assert abs(taken[source] - round(target)) == min(abs(sum_ - round(target)) for sum_ in choices)


def placed_rows(docs, **how):
    out = mixing.mixed_rows(docs, placed=("in_shard", "at_place"), **how)
    return [[(r.doc_id, r.source, r.in_shard, r.at_place) for r in part] for part in out.rdd.glom().collect()]


def test_rows_come_by_shard_in_the_order_of_place(some_docs, spark):
    parts = placed_rows(some_docs, shards=5, block_words=16)
    unsigned = [(shard, place % (1 << 64)) for part in parts for _, _, shard, place in part]
    shards = [shard for shard, _ in unsigned]
    assert shards == sorted(shards) and set(shards) == set(range(5))
    stretches = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 5)
    tops = [(shard, place * stretches >> 64) for shard, place in unsigned]
    assert tops == sorted(tops)
    assert all(part == sorted(part, key=lambda r: (r[2], r[3])) for part in parts)
    assert sorted(parts) == sorted(placed_rows(some_docs.repartition(3), shards=5, block_words=16))
    with pytest.raises(ValueError):
        mixing.mixed_rows(some_docs, placed=("source", "place"))


def test_the_tree_decides_the_shard_of_a_row(some_docs, monkeypatch):
    """The drawn ranges, recomputed from the tree, give every copy's shard; another tree gives others."""
    how = {"shards": 5, "block_words": 16}
    found, _ = copies_of(some_docs, **how)
    real = mixing.split_quotas

    _, pieces = mixing.mix(some_docs, whole_documents=True, **how)
    blocks = defaultdict(lambda: defaultdict(int))
    whole = defaultdict(int)
    for p in pieces.collect():
        blocks[found[p.row_key].source][p.shard] += 1
        whole[found[p.row_key].source] += p.words
    names = sorted(whole, key=lambda s: s.encode())
    quotas = np.array([-(-whole[name] // 16) for name in names])
    total = int(quotas.sum())
    room = np.array([total * (at + 1) // 5 - total * at // 5 for at in range(5)])
    number = int.from_bytes(mixing.SEED.encode()[:8], "big")
    outer = real(np.array([total]), room, [number])[0]
    tree = real(quotas, outer, [number, 1])
    # shards without a block of a source have no piece of it, and no others are without
    for at, name in enumerate(names):
        assert {s for s in range(5) if tree[at, s]} == set(blocks[name])
    rows = sorted(r for part in placed_rows(some_docs, **how) for r in part)
    monkeypatch.setattr(mixing, "split_quotas", lambda *given: real(*given)[:, ::-1])
    other = sorted(r for part in placed_rows(some_docs, **how) for r in part)
    assert [r[:2] for r in rows] == [r[:2] for r in other] and [r[2] for r in rows] != [r[2] for r in other]


def test_many_sources_are_split_in_two_tiers(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES_PER_TASK", 4)
    docs = spark.range(200).selectExpr("id AS doc_id", "'s' || id % 40 AS source", "repeat('w ', cast(5 + id % 60 AS int)) AS text")
    check(docs)


def test_whole_documents_come_nearest_to_the_target(spark, some_docs, odd_docs):
    few = spark.range(60).selectExpr("id AS doc_id", "repeat('w\n', cast(3 + id * id % 90 AS int)) AS text", "'s' || id % 25 AS source")
    for docs in (some_docs, odd_docs, few):
        lined, pieces = mixing.mix(docs, whole_documents=True)
        found = {r.row_key: r for r in lined.collect()}
        taken = defaultdict(int)
        for p in pieces.collect():
            taken[p.row_key, p.epoch] += p.words
        assert all(words == found[key]["size"] for (key, _), words in taken.items())
        per_source, sizes = defaultdict(int), defaultdict(list)
        for (key, _), count in taken.items():
            per_source[found[key].source] += count
        for r in found.values():
            sizes[r.source] += [r["size"]] * (r["size"] > 0)
        for r in found.values():
            off = abs(per_source[r.source] - r.target)
            if per_source[r.source] != min(sizes[r.source], default=0):
                assert off <= max(sizes[r.source]) / 2 + 1


def test_whole_documents_are_unchanged_rows(spark, some_docs, odd_docs):
    few = spark.range(60).selectExpr("id AS doc_id", "repeat('w\n', cast(3 + id * id % 90 AS int)) AS text", "'s' || id % 25 AS source")
    for docs in (some_docs, odd_docs, few):
        before, after = docs.collect(), mixing.mixed_rows(docs).collect()
        assert after and {(r.doc_id, r.text, r.source) for r in after} <= {(r.doc_id, r.text, r.source) for r in before}
        assert {r.source for r in after} == {r.source for r in before if words(r.text)}


def test_a_block_that_no_shard_drew_is_an_error(some_docs, monkeypatch):
    real = mixing.shard_quotas
    monkeypatch.setattr(mixing, "shard_quotas", lambda *given: real(*given).where("shard != 0"))
    for found in (mixing.taken_words, mixing.mixed_rows):
        with pytest.raises(Exception, match="no shard drew a block"):
            found(some_docs, block_words=16).collect()
