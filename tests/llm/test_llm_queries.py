"""The registered queries: SQL twins, and what the contracts say about the others."""

import hashlib
import zlib
from collections import defaultdict

import compare
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tallyweek.llm.queries import ORACLES, QUERIES, vocabulary_path


@pytest.fixture(scope="module")
def database(sf_dir):
    return compare.connect(sf_dir)


def test_registered():
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()
    assert [sum(name.startswith(f"op{n}_") for name in QUERIES) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, sf_dir, database, name):
    problems = compare.compare(QUERIES[name](spark, sf_dir), database, ORACLES[name])
    assert problems == []


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def test_shards(spark, sf_dir, documents):
    out = QUERIES["op3_shard_documents"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in out) == sorted(documents)
    sums, slots, of_text = np.zeros(16), defaultdict(list), defaultdict(set)
    for r in out:
        text = (documents[r.doc_id].text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "bytes", None)
        sums[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        of_text[text].add(r.shard)
    assert np.ptp(sums) < 0.001 * sums.mean()
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert all(len(found) == 1 for found in of_text.values())


def test_tokens(spark, sf_dir, documents):
    known = Tokenizer.from_file(vocabulary_path())
    for r in QUERIES["op6_bpe_round_trip"](spark, sf_dir).collect():
        text = documents[r.doc_id].text or ""
        ids = known.encode(text, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(known.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_languages(spark, sf_dir, documents):
    out = QUERIES["op8_language_id"](spark, sf_dir).collect()
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {n for n in documents if zlib.crc32(str(n).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == documents[r.doc_id].lang for r in held]) > 0.98


def test_scores(spark, sf_dir, documents):
    out = QUERIES["op7_ppm_score"](spark, sf_dir).collect()
    assert {r.doc_id for r in out if r.held_out} == {n for n in documents if zlib.crc32(str(n).encode()) % 7 == 2}
    assert len(out) == len(documents) and all(r.score < 0 and np.isfinite(r.score) for r in out)


def test_page_texts(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    import html
    import re

    for r in QUERIES["op10_html_text"](spark, sf_dir).collect():
        article = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split()) and r.n_chars == len(r.text)
