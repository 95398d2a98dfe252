"""Every registered query against its SQL twin on the test tables."""

import compare
import pytest

import __spark_entry__ as entry
from tallyweek.workloads.oracles import ORACLES
from tallyweek.workloads.queries import QUERIES


@pytest.fixture(scope="module")
def database(sf_dir):
    return compare.connect(sf_dir)


def test_same_keys():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, database, name):
    assert compare.compare(QUERIES[name](spark, sf_dir), database, ORACLES[name]) == []


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["year", "mmwr_week", "value", "n_missing_baseline", "selection"]
    assert frame.count() > 0
