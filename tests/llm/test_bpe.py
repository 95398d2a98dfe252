import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyweek.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def known():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(PATH)


def same(coder, known, text):
    ids = coder.encode(text).tolist()
    assert ids == known.encode(text, add_special_tokens=False).ids, repr(text)
    assert coder.decode(np.array(ids, np.int64)) == known.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(bpe.Coder(PATH), Tokenizer.from_file(PATH), text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abehinorstT' \n\t0129.,!-é<|endoftext>", max_size=120))
def test_texts_of_common_letters(text):
    same(bpe.Coder(PATH), Tokenizer.from_file(PATH), text)


def test_special_and_blanks(coder, known):
    for text in ["", " ", "\n\n \n", "a<|endoftext|>b<|endoftext|>", "<|endoftext|>", " 　\x85\xa0x\x1c\x1dy ", "don't I'LL we've", "x" * 3000, "ab" * 2000]:
        same(coder, known, text)


def test_random_letter_runs(coder, known):
    draw = random.Random(5)
    for _ in range(400):
        same(coder, known, "".join(draw.choice("aeinrstlohdcu") for _ in range(draw.randrange(1, 60))))


def test_unknown_ids_and_broken_bytes_decode(coder, known):
    assert coder.decode(np.array([10**6, 64], np.int64)) == known.decode([64], skip_special_tokens=False)
    ids = coder.encode("é🙂").tolist()
    assert coder.decode(np.array(ids[:1], np.int64)) == known.decode(ids[:1], skip_special_tokens=False)


def test_tables(odd_docs, no_docs, known):
    rows = {repr((r.doc_id, r.text)): r for r in odd_docs.collect()}
    coded = bpe.encode(odd_docs, PATH)
    assert coded.columns == [c for c in odd_docs.columns if c != "ids"] + ["ids"]
    back = bpe.decode(coded, PATH).collect()
    assert len(back) == odd_docs.count()
    for r in back:
        assert repr((r.doc_id, r.text)) in rows and r.decoded == (r.text or "")
        assert r.ids == known.encode(r.text or "", add_special_tokens=False).ids
    digests = {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(odd_docs, PATH).collect()}
    for r in back:
        assert (len(r.ids), hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r.decoded.encode()).hexdigest()) in digests
    for made in (bpe.encode(no_docs, PATH), bpe.decode(bpe.encode(no_docs, PATH), PATH), bpe.round_trip(no_docs, PATH)):
        assert made.count() == 0


def test_memory_of_pieces_is_bounded(coder, known, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    for text in ["some words here and there", "others come after them again", "some words here and there"]:
        same(coder, known, text)


def test_pieces_in_use_stay_remembered(coder, known, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    words = bpe.Vocabulary(PATH)
    plain, coded = words.encode_piece, []
    monkeypatch.setattr(words, "encode_piece", lambda piece: coded.append(piece) or plain(piece))
    for at in range(100):
        text = f" common words qz{chr(97 + at // 10)}{chr(97 + at % 10)} " + "long" * 20
        ids = np.frombuffer(words.encode_text(text, coder.findall), "<u4").tolist()
        assert ids == known.encode(text, add_special_tokens=False).ids
    assert coded.count(b" common") == coded.count(b" words") == 1
    for memory in (words.pieces, words.fits):
        assert 0 < len(memory) + len(memory.before) <= 40


def test_pairs_of_tokens_against_their_joined_text(coder):
    words, draw = coder.vocabulary, random.Random(6)
    for _ in range(3000):
        left, right = draw.randrange(len(words.tokens)), draw.randrange(len(words.tokens))
        # merging in rank order, pair by pair
        parts = [bytes([b]) for b in words.tokens[left] + words.tokens[right]]
        while True:
            ranked = [(words.merged.get(words.rank[a] * words.many + words.rank[b], words.many), at) for at, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, at = min(ranked, default=(words.many, 0))
            if rank == words.many:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        assert words.compatible(left, right) == (parts == [words.tokens[left], words.tokens[right]])
