"""Merkle manifest against a plain tree."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweek.llm import merkle_log
from tallyweek.llm.queries import QUERIES, verified_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """Levels of a tree and, per leaf, the digests beside its path."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h(*row[at : at + 3]) for at in range(0, len(row), 3)])
    paths = []
    for at in range(len(leaves)):
        path = []
        for row in levels[:-1]:
            first = at - at % 3
            path.append((row[first:at], row[at + 1 : first + 3]))
            at //= 3
        paths.append(path)
    return levels, paths


def expected(rows):
    """The contract in plain Python, for rows with doc_id, source, lang, n_chars and text."""

    def leaf(r, text):
        values = [r.doc_id, r.source, r.lang, r.n_chars, text]
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda entry: entry[:3])
        trees[name] = tree([entry[2] for entry in groups[name]])
    levels, top_paths = tree([trees[name][0][-1][0] for name in names])
    out = []
    for name, top_path in zip(names, top_paths):
        for (*_, own, r), path in zip(groups[name], trees[name][1]):
            crc = zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode())
            node = leaf(r, r.text.replace("\n", "")) if crc % 2 == 0 and r.text is not None else own
            beside = ""
            for before, after in path + top_path:
                beside += "".join(before + after)
                node = h(*before, node, *after)
            root = levels[-1][0]
            out.append((r.doc_id, own, trees[name][0][-1][0], root, h(beside), node, node == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def result(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("leaves", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 80, 81])
def test_positions(leaves):
    """Each node stands where its level and last leaf say; siblings end where the subtrees beside them end."""
    own = [hashlib.sha256(str(n).encode()).digest() for n in range(leaves)]
    levels, paths = tree([d.hex() for d in own])
    depth = merkle_log.height(leaves)
    assert depth == len(levels) - 1
    log = merkle_log.append_log(own, depth)
    assert len(log) == 32 * merkle_log.subtree_size(depth, leaves) == 32 * sum(map(len, levels))
    for level, row in enumerate(levels):
        for at, digest in enumerate(row):
            last = min((at + 1) * 3**level, leaves) - 1
            place = int(merkle_log.position(level, np.array([last]))[0])
            assert log[32 * place : 32 * place + 32].hex() == digest
            if at % 3:
                before = min(at * 3**level, leaves) - 1
                size = merkle_log.subtree_size(level, last - before)
                assert place - size == merkle_log.position(level, np.array([before]))[0]
    found = merkle_log.siblings(log, np.arange(leaves), leaves, depth)
    assert [[(s["before"], s["after"]) for s in path] for path in found] == [[("".join(b), "".join(a)) for b, a in p] for p in paths]


def test_a_short_last_block_is_as_high_as_the_others():
    own = [hashlib.sha256(str(n).encode()).digest() for n in range(10)]
    whole = tree([d.hex() for d in own])[0]
    last = merkle_log.append_log(own[9:], 2)
    assert last[-32:].hex() == whole[2][1] == h(h(own[9].hex()))


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_odd_documents(odd_docs, levels):
    assert result(verified_manifest(odd_docs, levels)) == expected(odd_docs.collect())


def test_many_tiers(spark):
    """One source of 700 rows, one of 1, several of few, in blocks of 3: six tiers."""
    rows = [(n, None if n == 5 else f"line {n}\nend", "en", "hot" if n < 700 else f"s{n % 11}" if n < 760 else None, n) for n in range(765)]
    rows += [(900, "x", "en", "ä", 1), (901, "x", "en", "Z", 1), (902, "x", "en", "", 1), (903, "x", "en", "z", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(7)
    wanted = expected(docs.collect())
    assert result(verified_manifest(docs, 1)) == wanted
    assert result(verified_manifest(docs, 3)) == wanted
    assert 0 < sum(not r[-1] for r in wanted) < len(wanted)


def test_empty_table(no_docs):
    assert verified_manifest(no_docs).collect() == []


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, m_at string").withColumn("leaf", F.sha2("m_at", 256))
    with pytest.raises(ValueError):
        merkle_log.manifest(docs, "m_at", "doc_id", "leaf")


def test_proof_of_chosen_rows_from_the_stored_log(spark, some_docs):
    leaves = some_docs.select("doc_id", "source", merkle_log.digest_of([F.col("doc_id"), F.col("text")]).alias("leaf"))
    made = merkle_log.manifest(leaves, "source", "doc_id", "leaf", 2)
    every = {r.doc_id: r for r in made.proofs().collect()}
    some = made.proofs(made.leaves().filter("doc_id % 17 = 3")).collect()
    assert {r.doc_id for r in some} == {n for n in every if n % 17 == 3} and all(every[r.doc_id] == r for r in some)
    root = made.root().collect()[0].m_root
    assert {r.root for r in every.values()} == {root}
    logs = made.log().collect()
    nodes = sum(len(r.m_log) // 32 for r in logs if r.part == "groups" and r.tier == 0)
    assert nodes >= len(every) and all(r.m_log[-32:].hex() == r.m_root for r in logs)
    # another text of one row is another root, and no other group's subroot changes
    other = leaves.withColumn("leaf", F.when(F.col("doc_id") == 100, F.sha2(F.lit("x"), 256)).otherwise(F.col("leaf")))
    changed = {r.doc_id: r for r in merkle_log.manifest(other, "source", "doc_id", "leaf", 2).proofs().collect()}
    source = {r.doc_id: r.source for r in some_docs.collect()}
    for n, r in changed.items():
        assert r.root != root and (r.subroot == every[n].subroot) == (source[n] != source[100])


def test_query_at_small_scale(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(QUERIES["op12_merkle_manifest"](spark, "/root/testdata/sf0.001")) == expected(docs.collect())
