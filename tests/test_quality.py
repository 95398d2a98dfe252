import pytest
from pyspark.sql import functions as F

from tallyweek.operators import quality

FACT = "year int, week int, state string, deaths double"


def pair(make, before, after):
    rows = [(2018, 1, s, float(d)) for s, d in before.items()] + [(2019, 1, s, float(d)) for s, d in after.items()]
    return make(FACT, rows)


@pytest.mark.parametrize(
    "scope, before, after, status",
    [
        ("overall", {"Ohio": 100}, {"Ohio": 105}, "reasonable"),
        ("overall", {"Ohio": 100}, {"Ohio": 106}, "warning"),
        ("overall", {"Ohio": 100}, {"Ohio": 94}, "warning"),
        ("entity", {"New York": 100}, {"New York": 110}, "reasonable"),
        ("entity", {"New York": 100}, {"New York": 111}, "warning"),
    ],
)
def test_thresholds(make, scope, before, after, status):
    got = {r.scope: r.status for r in quality.validate_yoy(pair(make, before, after)).collect()}
    assert got[scope] == status


def test_validation_needs_state_rows_of_both_years(make):
    assert quality.validate_yoy(pair(make, {}, {"Ohio": 1})).count() == 0
    assert quality.validate_yoy(pair(make, {"United States": 5}, {"Ohio": 1})).count() == 0
    assert quality.validate_yoy(pair(make, {"Ohio": 1}, {})).count() == 0


def test_entity_line_needs_both_years(make):
    frame = pair(make, {"Ohio": 10}, {"Ohio": 10, "New York": 5})
    assert [r.scope for r in quality.validate_yoy(frame).collect()] == ["overall"]
    assert quality.entity_yoy(frame).count() == 0
    line = quality.validate_yoy(frame).first()
    assert (line.states_before, line.states_after) == (1, 2)
    assert line.report == "all states: 10 -> 15 (+50.0%)"


def test_coverage_diff(make, rows):
    got = rows(quality.coverage_diff(pair(make, {"A": 1, "B": 1}, {"B": 1, "C": 1})))
    assert got == [("A", "missing in 2019"), ("C", "new in 2019")]


def test_top_five_ties_by_name(make):
    after = {"a": 60, "b": 50, "c": 40, "d": 30, "Texas": 20, "Ohio": 20, "United States": 999}
    got = quality.top_changes(pair(make, {"a": 50, "Texas": 1}, after)).collect()
    assert [r.state for r in got] == ["a", "b", "c", "d", "Ohio"]
    assert got[0].note == "+20.0% vs 2018" and got[1].note == "new in 2019"


def test_top_states(make):
    frame = pair(make, {}, {f"s{i:02d}": i for i in range(1, 13)})
    assert [r.state for r in quality.top_states(frame).collect()] == [f"s{i:02d}" for i in range(12, 2, -1)]


def test_coverage(make, rows):
    full = [(2019, w, "A", 1.0) for w in range(1, 53)]
    frame = make(FACT, full + full[:3] + [(2019, 1, "B", 1.0), (2019, 2, "B", 1.0), (2020, 1, "C", 1.0)])
    assert rows(quality.coverage(frame)) == [(2, 1, 27.0)]
    assert rows(quality.weeks_per_state(frame)) == [("A", 52), ("B", 2)]


def test_yearly_rate_uses_first_week_population(make, rows):
    frame = make(
        "year int, week int, state string, deaths double, population long",
        [(2019, 2, "United States", 10.0, 500), (2019, 1, "United States", 10.0, 1000), (2020, 1, "United States", 7.0, None)],
    )
    got = {r.year: r for r in quality.yearly_rate(frame).collect()}
    assert (got[2019].population, got[2019].rate_per_100k) == (1000, 2000.0)
    assert got[2019].report == "2019: 20 deaths | Pop: 1,000 | Rate: 2000.0 per 100k"
    assert got[2020].report == "2020: 7 deaths" and got[2020].rate_per_100k is None


def test_presence(make, rows):
    frame = make(FACT, [(2020, 2, "US", 1.0), (2020, 3, "US", 1.0), (2019, 1, "US", 4.0), (2019, 2, "US", 4.0)])
    assert rows(quality.presence(frame)) == [(0, None, "2,3", 8.0)]


def test_presence_counts_weeks_that_no_year_has_in_the_total(make, rows):
    frame = make(FACT, [(2020, 2, "US", 1.0), (2020, 99, "US", 1.0), (2019, 0, "US", 4.0), (2019, 54, "US", 2.0), (2019, 2, "US", 1.0), (2019, None, "US", 8.0)])
    assert rows(quality.presence(frame)) == [(0, None, "2", 15.0)]


def test_first_weeks(make):
    frame = make(FACT, [(2019, 1, "New York", 4.0), (2019, 2, "New York", 0.0), (2019, 6, "New York", 4.0), (2018, 1, "New York", 9.0)])
    assert [tuple(r) for r in quality.entity_first_weeks(frame).collect()] == [(1, 4.0)]
    assert quality.entity_total(frame).first()[0] == 17.0


def test_distinct_lists_and_info(make, rows):
    frame = make(FACT, [(2019, 1, "A", 1.0), (2020, 1, "A", 1.0)])
    assert rows(quality.distinct_lists(frame, ["year", "state"])) == [("state", "A"), ("year", "2019"), ("year", "2020")]
    assert rows(quality.dataset_info(frame)) == [(2, 2019, 2020)]
    assert rows(quality.week_range(frame)) == [(1, 1)]


def test_summary(make):
    frame = make(
        FACT + ", data_source string",
        [(2019, w, "B", 1.0, "late") for w in range(2, 54)]
        + [(2019, 1, "A", 2.0, "early"), (2020, 1, "A", 3.0, "late"), (2020, 1, "C", 3.0, "last")],
    )
    row = quality.summary(frame, "state").first()
    assert row.total_records == 55 and row.years_covered == "2019-2020" and row.total_deaths == 60.0
    assert row.data_sources == ["early", "late", "last"]
    assert row.yearly_totals == {2019: 54.0, 2020: 6.0}
    assert row.states_count == 3 and row.state_coverage == ["A", "B", "C"]
    assert tuple(row.coverage_2019) == (2, 1, 26.5)
    assert "states_count" not in quality.summary(frame, "national").columns
    later = quality.summary(frame.filter(F.col("year") == 2020), "state").first()
    assert later.coverage_2019 is None


def test_summary_of_nothing(make):
    assert quality.summary(make(FACT + ", data_source string", []), "state").count() == 0


def test_weeks_are_counted_as_bits(make, rows):
    """Weeks beyond the usual, negative and missing ones, and the same week from two sources."""
    weeks = [1, 1, 2, 53, 63, 64, 65, 128, -1, -64, 1_000_000, None]
    facts = make(
        "state string, year int, week int, data_source string, deaths double",
        [("Ohio", 2019, w, "A", 1.0) for w in weeks]
        + [("Ohio", 2019, 2, "B", 1.0), ("Ohio", 2018, 7, "A", 1.0), ("Texas", 2019, None, "A", 1.0), (None, 2019, 3, "A", 1.0)],
    )
    assert rows(quality.weeks_per_state(facts)) == [("Ohio", 10), ("Texas", 0)]
    assert rows(quality.weeks_per_year(facts)) == [("A", 2018, 1), ("A", 2019, 11), ("B", 2019, 1)]
    assert rows(quality.coverage(facts, full=10)) == [(2, 1, 5.0)]
    row = quality.summary(facts, "state").collect()[0]
    assert (row.total_records, row.total_deaths, row.coverage_2019.states_with_data) == (16, 16.0, 2)
    assert row.coverage_2019.average_weeks_per_state == (10 + 1) / 2 and row.state_coverage == ["Ohio", "Texas"]


@pytest.mark.parametrize("report", [quality.coverage, lambda facts: quality.summary(facts, "state"), quality.weeks_per_year])
def test_no_list_of_weeks_is_collected(make, report):
    facts = make("state string, year int, week int, data_source string, deaths double", [("Ohio", 2019, 1, "A", 1.0)])
    plan = report(facts)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set(" not in plan and "flatten(" not in plan and "distinct week" not in plan and "bit_or(" in plan
