import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweek.llm import language_id

WORDS = {
    "en": "the of and to in is that for with was this from have are not which".split(),
    "fr": "le la de et les des une que pour dans est avec sur pas vous être".split(),
    "de": "der die und das ist nicht mit für ein auf zu von den sich über wird".split(),
}


@pytest.fixture(scope="module")
def texts(spark):
    draw = np.random.default_rng(4)
    rows = []
    for number in range(400):
        lang = list(WORDS)[number % 3]
        rows.append((number, " ".join(draw.choice(WORDS[lang], 30)), lang if number % 11 else None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


def test_held_out_accuracy(texts):
    truth = {r.doc_id: list(WORDS)[r.doc_id % 3] for r in texts.collect()}
    out = language_id.identify_all(texts).collect()
    held = [r for r in out if r.held_out]
    assert len(out) == 400 and 60 < len(held) < 140
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.99
    assert all(0 <= r.score <= 1 for r in out)


def test_mixed_texts_are_ambiguous(texts, spark):
    model = language_id.fit(texts)
    mixed = " ".join(WORDS["en"] + WORDS["fr"])
    pure = " ".join(WORDS["en"])
    docs = spark.createDataFrame([(1, mixed), (2, pure), (3, None), (4, "1234 ²½ Ⅳ_ !!"), (5, "")], "doc_id long, text string")
    out = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert out[1].score < out[2].score and out[2].lang_pred == "en" and not out[2].ambiguous
    assert [out[n].lang_pred for n in (3, 4, 5)] == ["und"] * 3 and out[3].score == 0


def test_counts_are_of_all_rows(texts):
    counts = {}
    for r in language_id.language_counts(texts).collect():
        counts.setdefault(r.lang, np.zeros((language_id.SLICES, language_id.DIMENSIONS // language_id.SLICES), np.int64))[r.slice] = r.counts
    for lang, found in counts.items():
        own = [r.text for r in texts.collect() if r.lang == lang]
        total = sum(len(part[0]) for part in language_id.features(own))
        assert found.sum() == total == sum(3 * len(f" {t} ".encode()) - 6 for t in own)


@pytest.mark.parametrize("classes", [1, 2, 3, 5, 6, 7, 40, 200])
def test_codewords_differ(classes):
    code = language_id.codewords(classes)
    assert code.shape[0] == classes and len({row.tobytes() for row in code}) == classes
    if classes > 1:
        assert (abs(code.sum(axis=0)) < classes).all()
    if classes > 2:
        least = min((code[a] != code[b]).sum() for a in range(classes) for b in range(a))
        assert least >= 2  # a wrong bit can be borne or noticed


def test_odd(odd_docs, no_docs):
    out = language_id.identify_all(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert language_id.identify_all(no_docs).count() == 0


def test_nothing_learned(spark, odd_docs):
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify_all(unlabelled).collect()} == {"und"}
