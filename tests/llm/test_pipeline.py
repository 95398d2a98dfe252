import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyweek.llm import mixing, quality_rules
from tallyweek.llm.queries import vocabulary_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before and after each stage over the smallest tables."""
    sf_dir, folder = "/root/testdata/sf0.001", tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        out.append(docs.collect())
    return sf_dir, out


def test_columns(stages):
    for rows in stages[1][1:-1]:
        assert list(rows[0].__fields__) == COLUMNS


def test_quality(stages, spark):
    sf_dir, out = stages
    judged, _ = quality_rules.judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {r.doc_id for r in judged.where("kept").collect()}
    assert sorted(out[1]) == sorted(r for r in out[0] if r.doc_id in kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    long_enough = [r for r in out[0] if labels.get(r.doc_id) == 1 and len(WORD.findall(r.text)) >= 50]
    assert np.mean([r.doc_id in kept for r in long_enough]) > 0.98


def test_exact(stages):
    best = {}
    for r in stages[1][1]:
        key = re.sub("[A-Z]", lambda m: m[0].lower(), r.text)
        best[key] = max(best.get(key, r), r, key=lambda row: row.doc_id)
    assert sorted(stages[1][2]) == sorted(best.values())


def test_near(stages):
    rows = stages[1][2]

    def shingles(text):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        return {tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4))} if words else set()

    sets = [shingles(r.text) for r in rows]
    least = {r.doc_id: r.doc_id for r in rows}
    changed = True
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(least[rows[a].doc_id], least[rows[b].doc_id])
            for at in (a, b):
                if least[rows[at].doc_id] != low:
                    least[rows[at].doc_id], changed = low, True
    assert sorted(r.doc_id for r in stages[1][3]) == sorted(r.doc_id for r in rows if least[r.doc_id] == r.doc_id)


def test_mix(stages, spark):
    """Whole documents only, and each source as near its target as its documents around the end of its line allow."""
    before, after = stages[1][3], stages[1][4]
    assert after and {tuple(r) for r in after} <= {tuple(r) for r in before}
    assert max(Counter(r.doc_id for r in after).values()) <= 3
    docs = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    lined, _ = mixing.mix(docs)
    target = {r.source: r.target for r in lined.collect()}
    compared = 0
    for source, wanted in target.items():
        taken = sum(len(WORD.findall(r.text)) for r in after if r.source == source)
        sizes = [len(WORD.findall(r.text)) for r in before if r.source == source]
        assert abs(taken - wanted) <= max(sizes) / 2 + 1 or taken == min(sizes)
        if len(sizes) <= mixing.NEAR_END:
            all_have = round(wanted) // sum(sizes) * sum(sizes)
            sums = {all_have}
            for size in sizes:
                sums |= {found + size for found in sums}
            assert abs(taken - round(wanted)) == min(abs(found - round(wanted)) for found in sums - {0})
            compared += 1
    assert compared > 3


def test_encoding(stages):
    known = Tokenizer.from_file(vocabulary_path())
    expected = sorted((r.doc_id, known.encode(r.text, add_special_tokens=False).ids) for r in stages[1][4])
    assert sorted((r.doc_id, r.ids) for r in stages[1][5]) == expected
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in stages[1][5])


def test_run_is_the_stages(stages, spark):
    sf_dir, out = stages
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r.doc_id, r.ids) for r in whole.collect()) == sorted((r.doc_id, r.ids) for r in out[-1])


def test_odd_and_empty(odd_docs, no_docs, spark):
    for docs in (odd_docs, no_docs):
        docs = docs.select(*COLUMNS)
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, "/root/testdata/sf0.001")
            count = out.count()
            assert number == 4 or out.columns == COLUMNS
            assert number != 4 or count == docs.count()
            assert docs is not no_docs or count == 0


def test_blank_rows_survive_dedup(spark):
    docs = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, None, None, None), (3, "w", "en", "a", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.near(spark, docs, "").count() == 3
    assert {r.doc_id for r in corpus_pipeline.exact(spark, docs, "").collect()} == {2, 3}
    assert corpus_pipeline.mix(spark, docs, "").select(F.min("doc_id")).first()[0] == 3
