"""Prefix token counts against the sentencepiece library."""

import random

import pytest

from tallyweek.llm import prefix_tokens
from tallyweek.llm.queries import QUERIES, piece_model_path

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


@pytest.fixture(scope="module")
def known():
    return prefix_tokens.Pieces(piece_model_path())


ODD = [
    "", " ", "  ", " " * 37, "a", " a ", "a  b   c    d", "one\ntwo\n\n three\t\tfour\r\n{\r\n}\r", "<s> <unk> </s> <0x0A> <pad>",
    "ﬁ ½ Ａ ２", "▁x▁▁y", "\0a\0", "emoji 🙂🙂 zero​width é", "x" * 300, "ha" * 200, "aaaa bbbb" * 30,
    "日本語のテキスト 漢字", "Привет, мир! Привет, мир!", "const x = (a) => { return a?.b ?? [];   };\n\n        indented", "éèê ÄÖÜ ß",
]


def test_every_prefix_of_odd_texts(library, known):
    for text in ODD:
        counts = known.prefixes(text)
        expected = [len(library.encode(text[:end])) for end in range(len(text) + 1)]
        assert counts.tolist() == expected, text
        assert known.total(text) == expected[-1]


def test_random_texts(library, known):
    draw = random.Random(5)
    pieces = [library.id_to_piece(n).replace("▁", " ") for n in range(259, library.vocab_size())]
    alphabets = ["ab ", "the inr ", " \n\t\r;{}()", "aeiou 日本́🙂", "0123456789.,- "]
    for number in range(600):
        if number % 2:
            text = "".join(draw.choice(pieces) for _ in range(draw.randrange(1, 12)))
        else:
            text = "".join(draw.choice(alphabets[number // 2 % 5]) for _ in range(draw.randrange(1, 50)))
        assert known.total(text) == len(library.encode(text)), repr(text)
        end = draw.randrange(len(text) + 1)
        assert known.prefixes(text)[end] == len(library.encode(text[:end])), repr(text)


def test_unsupported_models_are_refused(tmp_path, monkeypatch):
    from sentencepiece import sentencepiece_model_pb2 as described

    model = described.ModelProto()
    with open(piece_model_path(), "rb") as file:
        model.ParseFromString(file.read())
    for change in (
        lambda m: setattr(m.trainer_spec, "byte_fallback", False),
        lambda m: setattr(m.normalizer_spec, "remove_extra_whitespaces", True),
        lambda m: setattr(m.trainer_spec, "model_type", described.TrainerSpec.UNIGRAM),
        lambda m: setattr(m.pieces[300], "type", described.ModelProto.SentencePiece.USER_DEFINED),
    ):
        other = described.ModelProto()
        other.CopyFrom(model)
        change(other)
        path = tmp_path / "other.model"
        path.write_bytes(other.SerializeToString())
        with pytest.raises(ValueError):
            prefix_tokens.Pieces(str(path))


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(prefix_tokens, "REMEMBERED", 20)
    small = prefix_tokens.Pieces(piece_model_path())
    text = " ".join(f"word{n}s" for n in range(200))
    assert small.total(text) == len(library.encode(text)) == small.prefixes(text)[-1]
    assert all(len(kept) <= 20 and len(kept.before) <= 20 for kept in (small.tables, small.totals, small.apart))


def test_query(spark, sf_dir, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = QUERIES["op13_prefix_tokens"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    for r in out:
        n = len(library.encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)


def test_odd_rows(odd_docs, no_docs, library):
    rows = odd_docs.collect()
    out = prefix_tokens.token_counts(odd_docs, piece_model_path()).collect()
    expected = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in rows]
    assert sorted(map(tuple, out), key=repr) == sorted(expected, key=repr)
    assert prefix_tokens.token_counts(no_docs, piece_model_path()).count() == 0
    assert prefix_tokens.prefix_table(no_docs, piece_model_path()).count() == 0


@pytest.mark.parametrize("budget", [-1, 0, 1, 7, 60, 100_000])
def test_budgets_from_the_stored_table(odd_docs, library, budget, tmp_path):
    path = f"{tmp_path}/table"
    prefix_tokens.prefix_table(odd_docs, piece_model_path(), block=100).write.parquet(path)
    table = odd_docs.sparkSession.read.parquet(path)
    texts = {(r.doc_id, r.text or "") for r in odd_docs.collect()}
    cut = prefix_tokens.cut_to_budget(odd_docs, table, max(budget, 0))
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()
    found = {(r.doc_id, r.text_key): r for r in prefix_tokens.fitting(table, budget).collect()}
    assert len(found) == (len(texts) if budget >= 0 else len(found))
    keyed = odd_docs.selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS k").distinct().collect()
    for doc_id, text, key in keyed:
        fits = [end for end in range(len(text) + 1) if len(text) <= 300 and len(library.encode(text[:end])) <= budget]
        if fits:
            assert found[doc_id, key].n_chars == fits[-1]
            assert found[doc_id, key].n_tokens == len(library.encode(text[: fits[-1]]))


def test_tokens_at(some_docs, library):
    spark = some_docs.sparkSession
    table = prefix_tokens.prefix_table(some_docs, piece_model_path(), block=64)
    texts = {r.doc_id: r.text for r in some_docs.collect()}
    wanted = [(n, at) for n in (0, 5, 17, 80) for at in (0, 1, 63, 64, 100, 10**6)]
    out = prefix_tokens.tokens_at(table, spark.createDataFrame(wanted, "doc_id long, n_chars long"), block=64).collect()
    assert {(r.doc_id, r.n_chars): r.n_tokens for r in out if r.n_tokens is not None} == {
        (n, at): len(library.encode(texts[n][:at])) for n, at in wanted if at <= len(texts[n])
    }
