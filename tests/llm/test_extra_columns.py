"""Row-returning operators keep extra columns, whatever their names."""

import ast
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import tallyweek.llm
from tallyweek.llm import exact_dedup, jaccard_join, mixing, quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def helper_names():
    """Every name that a string in the sources spells, so every column an operator may use inside."""
    found = set()
    for path in Path(tallyweek.llm.__file__).parent.glob("*.py"):
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Constant) and isinstance(node.value, str) and node.value.isidentifier():
                found.add(node.value.lower())
    return sorted(found - set(COLUMNS))


@pytest.fixture(scope="module")
def extra(some_docs, spark):
    names = helper_names()
    assert {"_id", "_key", "_text", "_digest", "_row", "_stays", "_times", "row", "shard"} <= set(names) and len(names) > 150
    rows = some_docs.unionByName(some_docs.limit(3))
    columns = [F.concat(F.lit(f"{name} of "), F.col("doc_id")).alias(name) for name in names]
    return rows.select("*", *columns).checkpoint(), names


def labels(spark, docs):
    return docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS quality", "0 AS toxic", "'clash' AS _id")


@pytest.mark.parametrize("stage", ["quality", "exact", "near", "mix"])
def test_values_come_back(spark, extra, stage):
    docs, names = extra
    run = {
        "quality": lambda d: quality_rules.keep_good(d, labels(spark, d)),
        "exact": exact_dedup.drop_copies,
        "near": lambda d: jaccard_join.one_of_each(d, width=5, percent=80),
        "mix": mixing.mixed_rows,
    }[stage]
    out = run(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[name] == f"{name} of {r.doc_id}" for r in rows for name in names)
    plain = run(docs.select(*COLUMNS)).select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain)
