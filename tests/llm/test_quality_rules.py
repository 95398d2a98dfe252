import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyweek.llm import quality_rules
from tallyweek.llm.quality_rules import Condition

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[at : at + 3]) for at in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {at + step for at, window in enumerate(windows) if times[window] > 1 for step in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


def test_statistics(odd_docs, some_docs, no_docs):
    for docs in (odd_docs, some_docs):
        for row in quality_rules.text_statistics(docs).collect():
            assert tuple(row[name] for name in quality_rules.BASE) == statistics(row.text), row.doc_id
    assert quality_rules.text_statistics(no_docs).count() == 0


def test_random_repetitions(spark):
    draw = random.Random(8)
    rows = [(n, draw.choice(["", "\n", " "]).join(draw.choice(["a", "b", "c ", " #x", "\n", "dé\n"]) for _ in range(draw.randrange(0, 90)))) for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for row in quality_rules.text_statistics(docs).collect():
        assert tuple(row[name] for name in quality_rules.BASE) == statistics(row.text), row.text


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_windows_with_one_hash_are_told_apart(spark, odd_docs, bits):
    """With so few bits most hashes stand for many windows."""
    draw = random.Random(bits)
    rows = [(n, " ".join(f"w{draw.randrange(3 + n)}" for _ in range(draw.randrange(0, 120)))) for n in range(120)]
    for docs in (spark.createDataFrame(rows, "doc_id long, text string"), odd_docs):
        for row in quality_rules.text_statistics(docs, hash_bits=bits).collect():
            assert tuple(row[name] for name in quality_rules.BASE) == statistics(row.text), row.text


def test_two_million_words(spark):
    draw = random.Random(1)
    words = [f"w{draw.randrange(600)}" for _ in range(2_000_000)]
    text = " ".join(words)
    row = quality_rules.text_statistics(spark.createDataFrame([(1, text)], "doc_id long, text string")).drop("text").collect()[0]
    assert tuple(row[name] for name in quality_rules.BASE) == statistics(text)


@pytest.fixture(scope="module")
def labelled(spark):
    """Bad where x is large, or where y is small and z large; a few labels are wrong."""
    draw = random.Random(2)
    rows = []
    for number in range(3000):
        x, y, z = (draw.random() for _ in range(3))
        bad = x > 0.9 or (y < 0.2 and z > 0.5)
        rows.append((bad if draw.random() > 0.01 else not bad, number % 3 == 0, x, y, z if number % 50 else None))
    return spark.createDataFrame(rows, "bad boolean, pruning boolean, x double, y double, z double")


def test_rules_are_found(labelled):
    rules = quality_rules.learn_rules(labelled, ["x", "y", "z"], least_precision=0.8)
    assert 2 <= len(rules) <= 8
    assert any(len(rule) == 1 and rule[0].name == "x" and rule[0].above and 0.85 < rule[0].cut < 0.95 for rule in rules)
    assert any({c.name for c in rule} == {"y", "z"} for rule in rules)
    wrong = labelled.where(~F.col("bad") != quality_rules.verdict(rules)).count()
    assert wrong < 150


def test_histograms_agree_with_counting(labelled):
    binned, edges = quality_rules._binned(labelled, ["x", "z"], 5)
    for condition, bad, good in quality_rules._narrowed(binned, edges):
        assert (bad, good) == tuple(quality_rules._counted(binned, [quality_rules.covers((condition,))])[0])


def test_no_rule_without_both_kinds(labelled):
    for rows in (labelled.where("bad"), labelled.where("NOT bad"), labelled.where("false")):
        assert quality_rules.learn_rules(rows, ["x", "y"]) == []


def test_order_and_nulls(spark):
    rows = spark.createDataFrame([(1.0,), (0.0,), (None,)], "x double")
    rule = (Condition("x", 0.5, True),)
    assert [r[0] for r in rows.select(quality_rules.verdict([rule])).collect()] == [False, True, True]


def test_kept(odd_docs, some_docs, no_docs, spark):
    labels = spark.createDataFrame([(n, n % 2) for n in range(260)] + [(None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    for docs in (odd_docs, some_docs, no_docs):
        out, _ = quality_rules.judged(docs, labels)
        rows = out.collect()
        assert len(rows) == docs.count()
        for row in rows:
            failed = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
            assert row.base_failed == failed and not (failed and row.kept) and row.kept is not None
        kept = quality_rules.keep_good(docs, labels)
        assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)


def test_no_labels_keep_all_that_pass(some_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    out, rules = quality_rules.judged(some_docs, none)
    assert rules == [] and out.where("kept = base_failed").count() == 0


def test_plan_is_native(some_docs, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    plan = quality_rules.keep_good(some_docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
