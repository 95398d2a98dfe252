import pytest
from pyspark.sql import functions as F

from tallyweek.functions import columns
from tallyweek.operators import filters
from tallyweek.schema import JURISDICTIONS, SOURCE


def test_discover(make):
    frame = make("`Week Ending Date` string, `Jurisdiction of Occurrence` string, `All Cause` string, x int", [])
    assert columns.discover_columns(frame).columns == ["week_ending_date", "state", "deaths", "x"]


@pytest.mark.parametrize("extra", ["`Natural Cause` string", "deaths string", "`Total Deaths` string"])
def test_discover_refuses_ambiguity(make, extra):
    with pytest.raises(ValueError):
        columns.discover_columns(make(f"`All Cause` string, {extra}", []))


def test_available_and_rename(make):
    frame = make("b int, a int", [])
    assert columns.keep_available(frame, ["a", "missing", "b"]).columns == ["a", "b"]
    assert columns.rename_present(frame, {"a": "z", "missing": "y"}).columns == ["b", "z"]


def test_week_pair(make):
    assert columns.with_week_pair(make("week int", [])).columns == ["week", "mmwr_week"]
    assert columns.with_week_pair(make("mmwr_week int", [])).columns == ["mmwr_week", "week"]


def test_typed_empty(spark):
    frame = columns.typed_empty(spark, SOURCE)
    assert frame.columns == SOURCE.fieldNames() and frame.count() == 0
    assert [f.dataType for f in frame.schema] == [f.dataType for f in SOURCE]


def test_completeness(make, rows):
    frame = make("a int, b string, c double", [(1, None, None), (1, "x", 2.0)])
    assert rows(frame.select(columns.completeness(["a", "b", "c"]))) == [(1,), (3,)]


def test_exclude_totals_keeps_missing_state(make, rows):
    frame = make("state string", [("US",), ("Total",), (None,), ("Ohio",), ("us",)])
    assert rows(filters.exclude_totals(frame)) == [("Ohio",), ("us",), (None,)]


def test_measure_and_week(make, rows):
    frame = make("week double, deaths double", [(0.5, 1.0), (0.0, 1.0), (54.0, 1.0), (53.0, 0.0), (53.0, 2.0), (None, 3.0)])
    kept = filters.valid_week(filters.valid_measure(frame))
    assert rows(kept) == [(0.5, 1.0), (53.0, 2.0)]


def test_jurisdictions():
    assert len(JURISDICTIONS) == len(set(JURISDICTIONS)) == 53
    assert JURISDICTIONS == sorted(JURISDICTIONS)


def test_selection(make, rows):
    frame = make("state string", [("Ohio",), ("Texas",), (None,)])
    assert len(rows(filters.select_states(frame, ["All States"]))) == 3
    assert len(rows(filters.select_states(frame, []))) == 3
    assert rows(filters.select_states(frame, ["All States", "Ohio"])) == [("Ohio",)]
    assert filters.selection_label(["All States"]) == "All States Combined"
    assert filters.selection_label(["Ohio", "Texas"]) == "Ohio, Texas"


def test_choices(make):
    frame = make("state string", [("Texas",), ("Alabama",), ("Texas",)])
    assert [r.state for r in filters.state_choices(frame).collect()] == ["All States", "Alabama", "Texas"]


def test_split_puts_missing_state_on_the_state_side(make, rows):
    frame = make("state string", [("United States",), ("Ohio",), (None,)])
    national, states = filters.split_national_state(frame)
    assert rows(national) == [("United States",)] and rows(states) == [("Ohio",), (None,)]
    assert rows(frame.select(filters.side())) == [("national",), ("state",), ("state",)]
    assert rows(frame.filter(~filters.is_national()).select(F.col("state"))) == [("Ohio",), (None,)]
