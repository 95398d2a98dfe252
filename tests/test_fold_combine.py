import pytest

from tallyweek.operators import combine, fold
from tallyweek.rules import DEFAULT, PARITY

KEYS = "year int, week int, mmwr_week int, state string, deaths double"


def test_fold_both(make, rows):
    frame = make(
        KEYS,
        [(2019, 2, 2, s, d) for s, d in (
            ("New York", 10.0), ("New York City", 5.0), ("Bronx NYC", 1.0), ("nyc lower", 7.0), ("Ohio", 3.0), ("Ohio", 4.0),
        )],
    )
    for how in ("sum", "data"):
        got = rows(fold.fold_entities(frame, how=how), "state", "deaths")
        assert got == [("New York", 16.0), ("Ohio", 7.0), ("nyc lower", 7.0)]


def test_fold_city_only(make, rows):
    frame = make(KEYS, [(2019, 2, 2, "New York City", 5.0), (2019, 2, 2, "New York City", 6.0)])
    assert rows(fold.fold_entities(frame, how="data"), "state", "deaths") == [("New York", 5.0), ("New York", 6.0)]
    assert rows(fold.fold_entities(frame), "state", "deaths") == [("New York", 11.0)]


def test_fold_state_only(make, rows):
    frame = make(KEYS, [(2019, 2, 2, "New York", 5.0), (2019, 2, 2, "Ohio", 3.0), (2019, 2, 2, "Ohio", None)])
    assert rows(fold.fold_entities(frame, how="data")) == rows(frame) == rows(fold.fold_entities(frame, how="none"))
    assert rows(fold.fold_entities(frame), "state", "deaths") == [("New York", 5.0), ("Ohio", 3.0)]


def test_a_stray_city_changes_no_other_key(make, rows):
    ohio = [(2019, 2, 2, "Ohio", 80.0), (2019, 2, 2, "Ohio", 90.0), (2019, 3, 3, "New York", 1.0)]
    stray = (2019, 9, 9, "Bronx NYC", 4.0)
    for frame in (make(KEYS, ohio), make(KEYS, [*ohio, stray])):
        folded = fold.fold_entities(frame)
        assert rows(folded.filter("state = 'Ohio'"), "deaths") == [(170.0,)]


def test_the_historical_fold_keeps_row_order(make, rows):
    frame = make(KEYS + ", row_ord int", [(2019, 2, 2, "Ohio", 5.0, 3), (2019, 2, 2, "Ohio", 5.0, 4)])
    assert rows(fold.fold_entities(frame, how="data")) == rows(frame)


def test_fold_keeps_missing_keys_and_states(make, rows):
    frame = make(
        KEYS,
        [(2019, 2, 2, "New York", 1.0), (2019, 2, 2, "New York City", 1.0), (2019, None, None, "Ohio", 1.0),
         (2019, None, None, "Ohio", 2.0), (2019, 1, 1, None, 9.0)],
    )
    got = rows(fold.fold_entities(frame), "week", "state", "deaths")
    assert got == [(1, None, 9.0), (2, "New York", 2.0), (None, "Ohio", 3.0)]


def test_fold_separates_date_spellings(make, rows):
    frame = make(
        "year int, week int, week_ending_date string, state string, deaths double, row_ord int",
        [(2019, 2, "2019-01-12", "New York", 10.0, 1), (2019, 2, "1/12/2019", "New York City", 5.0, 2)],
    )
    assert len(rows(fold.fold_entities(frame))) == 2
    assert "row_ord" not in fold.fold_entities(frame).columns


def test_unknown_fold(make):
    with pytest.raises(ValueError):
        fold.fold_entities(make(KEYS, []), how="guess")


def test_first_per_entity(make, rows):
    frame = make("state string, ord int, note string", [("A", 2, "late"), ("A", 1, None), ("A", 3, "later"), ("B", 1, None)])
    assert rows(fold.first_per_entity(frame, ["note"], ["ord"])) == [("A", "late"), ("B", None)]


def test_national_rollup(make, rows):
    frame = make(
        "year int, week int, mmwr_week int, week_ending_date string, state string, deaths double",
        [(2019, 1, 1, None, "A", 1.0), (2019, 1, 1, "d1", "B", 2.0), (2019, 1, 1, "d2", "C", 4.0), (2019, None, None, "x", "A", 9.0)],
    )
    assert rows(fold.national_rollup(frame)) == [
        (2019, 1, 1, "d1", "United States", 7.0, "Calculated from State Data")
    ]


def test_union_skips_absent_and_fills(make, rows):
    a = make("k int, x string", [(1, "a")])
    b = make("k int, y int", [(2, 5)])
    merged = combine.union_sources([None, a, None, b])
    assert rows(merged, "k", "x", "y", "source_ord") == [(1, "a", None, 1), (2, None, 5, 3)]
    assert combine.union_sources([None, None]) is None
    assert combine.merge_clean([None]) is None


SOURCE = "year int, week int, mmwr_week int, week_ending_date string, state string, deaths double, data_source string"


def test_dedup_prefers_the_complete_row_then_the_earlier_source(make, rows):
    second = make(SOURCE, [(2020, 5, 5, None, "United States", 1.0, "two"), (2020, 6, 6, None, "Ohio", 1.0, "two")])
    third = make(SOURCE, [(2020, 6, 6, None, "Ohio", 2.0, "three")])
    fourth = make(SOURCE, [(2020, 5, 5, "d", "United States", 2.0, "four")])
    best = combine.dedup_best(combine.union_sources([None, second, third, fourth]))
    assert rows(best, "week", "data_source") == [(5, "four"), (6, "two")]


def test_dedup_ties_follow_row_order(make, rows):
    frame = make("year int, week int, state string, deaths double, row_ord struct<file:string,position:long>",
                 [(1, 1, "A", 9.0, ("f", 2)), (1, 1, "A", 1.0, ("f", 10)), (1, 1, "A", 5.0, ("e", 99))])
    for parts in (1, 3):
        best = combine.dedup_best(frame.repartition(parts))
        assert rows(best, "deaths") == [(5.0,)]


TEXT = "year string, week string, state string, deaths string, data_source string"


def test_clean(make, rows):
    frame = make(
        TEXT,
        [
            ("2020", "1.9", "Ohio", " 12 ", "s"),
            ("2020", "2", "Ohio", "1,234", "s"),
            ("2020", "3", None, "5", "s"),
            ("2020", None, "Ohio", "5", "s"),
            ("x", "4", "Ohio", "5", "s"),
            ("2020", "5", "Guam", "5", "s"),
            ("2020", "6", "Ohio", "0", "s"),
            ("2020", "7", "United States", "5", "s"),
        ],
    )
    got = rows(combine.clean(frame), "year", "week", "mmwr_week", "state", "deaths")
    assert got == [(2020, 1, 1, "Ohio", 12.0), (2020, 7, 7, "United States", 5.0)]


def test_clean_copies_week_into_missing_mmwr_week(make, rows):
    frame = make("year int, week int, mmwr_week int, state string, deaths double", [(2020, 3, None, "Ohio", 1.0)])
    assert rows(combine.clean(frame), "mmwr_week") == [(3,)]


def test_relabel_before_or_after_dedup(make, rows):
    frame = make(SOURCE, [(2019, 2, 2, "d", "New York", 10.0, "s"), (2019, 2, 2, "d", "New York City", 5.0, "s")])
    assert len(rows(combine.clean(frame, DEFAULT))) == 1
    assert rows(combine.clean(frame, PARITY), "state", "deaths") == [("New York", 10.0), ("New York", 5.0)]


def test_unusable_row_displaces_only_in_parity(make, rows):
    first = make(SOURCE, [(2020, 1, 1, "d", "Ohio", 0.0, "one")])
    second = make(SOURCE, [(2020, 1, 1, "d", "Ohio", 5.0, "two")])
    merged = combine.union_sources([first, second])
    assert rows(combine.clean(merged, DEFAULT), "data_source") == [("two",)]
    assert rows(combine.clean(merged, PARITY)) == []


def test_observed_rows(spark, make):
    counts = combine.RowCounts()
    counts.watch(make("x int", [(1,), (2,)]), "step").collect()
    assert counts.watch(None, "other") is None
    assert [tuple(r) for r in counts.table(spark, ["step", "other"]).collect()] == [(0, "step", 2), (1, "other", 0)]


def test_keys_that_are_no_integer_leave(make, rows):
    frame = make(
        "year double, week double, mmwr_week double, state string, deaths double",
        [(2020.0, float("inf"), float("inf"), "Ohio", 1.0), (2020.0, 1e12, 1e12, "Ohio", 2.0), (2020.0, 3.0, 3.0, "Ohio", 4.0)],
    )
    for rules in (DEFAULT, PARITY):
        assert rows(combine.clean(frame, rules), "week", "deaths") == [(3, 4.0)]


def test_lineage(make, rows):
    frame = make(SOURCE, [
        (2020, 1, 1, None, "Ohio", 1.0, "a"), (2020, 1, 1, None, "Ohio", 2.0, "b"), (2020, 1, 1, None, "Guam", 2.0, "b"),
        (2020, None, None, None, "Ohio", 2.0, "b"),
    ])
    got = {r.stage: r.rows for r in combine.row_lineage(frame).collect()}
    assert got == {"union": 4, "complete": 3, "dedup": 2, "known_state": 1}
