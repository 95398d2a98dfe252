import pytest

from tallyweek.rules import DEFAULT, PARITY
from tallyweek.sources import ingest, scan, sinks


@pytest.fixture
def folder(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(path)

    return write


def test_scan_csv(spark, folder, rows):
    path = folder("a.csv", 'k,"na,me"\n1,"x ""y"""\n2,NA\n3,\n,nan\n')
    frame = scan.scan_csv(spark, path)
    assert frame.dtypes == [("k", "string"), ("na,me", "string")]
    assert rows(frame) == [("1", 'x "y"'), ("2", None), ("3", None), (None, None)]


def test_quoted_line_breaks(spark, folder, rows):
    path = folder("b.csv", 'k,v\n1,"two\nlines"\n')
    assert rows(scan.scan_csv(spark, path, multiline=True)) == [("1", "two\nlines")]


def test_missing_path_is_no_source(spark, tmp_path):
    assert scan.scan_csv(spark, str(tmp_path / "nowhere")) is None
    assert scan.scan_landing(spark, str(tmp_path), "provisional") is None
    assert scan.scan_compiled(spark, str(tmp_path / "nowhere"), "parquet") is None
    assert scan.scan_population(spark, str(tmp_path / "nowhere")) is None


def test_empty_folder_and_empty_files(spark, tmp_path, folder):
    (tmp_path / "provisional").mkdir()
    assert scan.scan_landing(spark, str(tmp_path), "provisional") is None
    folder("blank/a.csv", "")
    folder("headed/a.csv", "State,Year\n")
    for name in ("blank", "headed"):
        assert ingest.ingest_provisional(scan.scan_landing(spark, str(tmp_path), name)).count() == 0


def test_row_order_follows_the_file(spark, folder):
    body = "\n".join(str(i) for i in range(500))
    frame = scan.scan_csv(spark, folder("c.csv", "v\n" + body + "\n"), row_order=True)
    got = [int(r.v) for r in frame.repartition(4).orderBy("row_ord").collect()]
    assert got == list(range(500))


def test_compiled_file_of_another_tool(spark, folder, rows):
    path = folder(
        "facts.csv",
        "year,week,mmwr_week,state,deaths,population,mortality_rate_per_100k,data_source\n"
        "2019,1,1,Ohio,2500.0,11689100.0,21.4,x\n2019,2,2,Ohio,2400,,,x\n",
    )
    assert rows(scan.scan_compiled(spark, path)) == [
        (2019, 1, 1, None, "Ohio", 2500.0, 11689100, 21.4, "x"),
        (2019, 2, 2, None, "Ohio", 2400.0, None, None, "x"),
    ]


def test_population_inputs(spark, folder, rows):
    path = folder("pop.csv", "year,state,population\n2015,Ohio,10.0\n2016,Ohio,NA\n")
    long_form = scan.scan_population(spark, path)
    assert rows(long_form) == [(2015, "Ohio", 10), (2016, "Ohio", None)]
    nested = scan.population_from_dict(spark, {2015: {"Ohio": 10, "Texas": 20}, 2016: {"Ohio": 11}})
    assert rows(nested) == [(2015, "Ohio", 10), (2015, "Texas", 20), (2016, "Ohio", 11)]
    assert nested.dtypes == long_form.dtypes


DATED = "`Week Ending Date` string, `Jurisdiction of Occurrence` string, `All Cause` string"


def test_dated_file(make, rows):
    frame = make(
        DATED,
        [
            ("2019-01-05", "Alabama", "1078"),
            ("1/12/2019", "Alabama", "1,078"),
            ("2019/1/19", "New York", "10"),
            ("1/19/2019", "New York City", "5"),
            ("not a date", "Ohio", "7"),
            ("2019-01-05", "United States", "9"),
            ("2019-01-05", "Ohio", "0"),
        ],
    )
    got = rows(ingest.ingest_dated_file(frame), "year", "week", "week_ending_date", "state", "deaths", "data_source")
    label = "Local 2019 File"
    assert got == [
        (2019.0, 1.0, "2019-01-05", "Alabama", 1078.0, label),
        (2019.0, 3.0, "2019-01-19", "New York", 15.0, label),
        (None, None, "not a date", "Ohio", 7.0, label),
    ]
    old = rows(ingest.ingest_dated_file(frame, PARITY), "week", "week_ending_date", "state", "deaths")
    assert old == [
        (1.0, "1/19/2019", "New York", 5.0),
        (1.0, "2019/1/19", "New York", 10.0),
        (51.0, "2019-01-05", "Alabama", 1078.0),
        (None, "not a date", "Ohio", 7.0),
    ]


def test_dated_file_without_dates_or_columns(make, rows):
    undated = make("Jurisdiction string, Deaths string", [("Ohio", "5")])
    assert rows(ingest.ingest_dated_file(undated), "year", "week", "state") == [(None, None, "Ohio")]
    useless = ingest.ingest_dated_file(make("Jurisdiction string", [("Ohio",)]))
    assert useless.count() == 0 and "deaths" in useless.columns


def test_country_series(make, rows):
    frame = make(
        "country_name string, year string, time string, time_unit string, deaths string",
        [
            ("United States", "2015", "1", "weekly", "61000.0"),
            ("United States", "2020", "2", "monthly", "5"),
            ("United States", "2014", "1", "weekly", "5"),
            ("United States", "2021", "1", "weekly", "5"),
            ("United States", "x", "1", "weekly", "5"),
            ("France", "2015", "1", "weekly", "5"),
        ],
    )
    columns = ("year", "week", "mmwr_week", "state", "deaths")
    first = (2015.0, 1.0, 1.0, "United States", 61000.0)
    assert rows(ingest.ingest_country_series(frame), *columns) == [first]
    assert rows(ingest.ingest_country_series(frame, PARITY), *columns) == [first, (2020.0, 2.0, 2.0, "United States", 5.0)]
    assert "week_ending_date" not in ingest.ingest_country_series(frame).columns


def test_provisional(make, rows):
    frame = make(
        "Year string, `MMWR Week` string, `Week Ending Date` string, State string, `Total Deaths` string, Extra string",
        [
            ("2020", "1", "01/04/2020", "New York", "1500", "e"),
            ("2020", "1", "2020-01-04", "New York City", "500", "e"),
            ("2019/2020", "1", "01/04/2020", "Ohio", "5", "e"),
            ("2019", "1", "01/04/2020", "Ohio", "5", "e"),
            ("2020", "54", "01/04/2020", "Ohio", "5", "e"),
            ("2020", "0", "01/04/2020", "Ohio", "5", "e"),
            ("2020", None, "01/04/2020", "Ohio", "5", "e"),
            ("2020", "53", "01/04/2020", "Ohio", "1,500", "e"),
            ("2020", "53", "01/04/2020", "Guam", "5", "e"),
        ],
    )
    got = rows(ingest.ingest_provisional(frame), "year", "week", "week_ending_date", "state", "deaths")
    assert got == [(2020.0, 1.0, "2020-01-04", "New York", 2000.0), (2020.0, 53.0, "2020-01-04", "Guam", 5.0)]
    assert len(rows(ingest.ingest_provisional(frame, PARITY))) == 3
    assert ingest.ingest_provisional(frame.drop("Total Deaths")).count() == 0


def test_packed_week(make, rows):
    frame = make(
        "age string, `MMWR Year/Week` string, State string, `All Deaths` string",
        [
            ("All", "201501", "Texas", "3700"),
            ("All", "201852", "New York City", "10"),
            ("18-64", "201501", "Texas", "3"),
            ("All", "201901", "Texas", "3"),
            ("All", "abc", "Texas", "3"),
            ("All", "201500", "Texas", "3"),
            ("All", "201502", "Texas", "3,700"),
        ],
    )
    got = rows(ingest.ingest_packed_week(frame), "year", "week", "state", "deaths")
    assert got == [(2015.0, 1.0, "Texas", 3700.0), (2018.0, 52.0, "New York", 10.0)]
    assert ingest.ingest_packed_week(frame.drop("age")).count() == 0


def test_thousands_can_be_accepted(make, rows):
    from dataclasses import replace

    frame = make(DATED, [("2019-01-05", "Ohio", "1,078")])
    assert rows(ingest.ingest_dated_file(frame, replace(DEFAULT, thousands=",")), "deaths") == [(1078.0,)]


def test_sorted_csv(spark, make, tmp_path):
    frame = make("year int, week int, state string, deaths double, junk int",
                 [(2020, 2, "B", 1.0, 0), (2020, 1, "Z", 1.0, 0), (2019, 9, 'A "q", x', 1.0, 0)])
    path = str(tmp_path / "out")
    sinks.write_csv(frame.repartition(3), path, ["year", "week", "state"])
    sinks.write_csv(frame.repartition(3), path, ["year", "week", "state"])
    lines = []
    for part in sorted((tmp_path / "out").glob("part-*")):
        header, *body = part.read_text().splitlines()
        assert header == "year,week,state,deaths"
        lines += body
    assert [line.split(",")[:2] for line in lines] == [["2019", "9"], ["2020", "1"], ["2020", "2"]]
    assert 'A "q", x' in {r.state for r in scan.scan_csv(spark, path).collect()}


PROVISIONAL = "Year string, `MMWR Week` string, `Week Ending Date` string, State string, `Total Deaths` string"


@pytest.mark.parametrize("rules, expected", [(DEFAULT, [10.0]), (PARITY, [5.0, 5.0])], ids=["default", "parity"])
@pytest.mark.parametrize("name, state", [("New York City", "New York"), ("Ohio", "Ohio")])
def test_city_or_state_alone(make, rows, rules, expected, name, state):
    """By default equal keys are always summed; the historical fold only renames."""
    twice = [("2020", "1", "2020-01-04", name, "5")] * 2
    got = rows(ingest.ingest_provisional(make(PROVISIONAL, twice), rules), "week", "state", "deaths")
    assert got == [(1.0, state, value) for value in expected]
    dated = make(DATED, [("2019-01-12", name, "5")] * 2)
    assert rows(ingest.ingest_dated_file(dated, rules), "state", "deaths") == [(state, value) for value in expected]


def test_dated_rows_keep_their_year(make, rows):
    frame = make(DATED, [("2020-01-04", "Ohio", "99"), ("2019-01-05", "Ohio", "1"), ("2013-06-01", "Ohio", "2"), ("soon", "Ohio", "3")])
    got = rows(ingest.ingest_dated_file(frame), "year", "week", "deaths")
    assert got == [(2013.0, 22.0, 2.0), (2019.0, 1.0, 1.0), (2020.0, 1.0, 99.0), (None, None, 3.0)]
    assert {r.year for r in ingest.ingest_dated_file(frame, PARITY).collect()} == {2019.0}


def test_building_an_ingest_starts_no_job(spark, make):
    frame = make(DATED, [("2019-01-12", "New York City", "5")])
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        for rules in (DEFAULT, PARITY):
            ingest.ingest_dated_file(frame, rules)
            ingest.ingest_provisional(make(PROVISIONAL, [("2020", "1", "2020-01-04", "Ohio", "5")]), rules)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("rules", [DEFAULT, PARITY])
def test_year_range_reaches_a_typed_scan(spark, tmp_path, rules):
    path = str(tmp_path / "typed")
    spark.createDataFrame(
        [("United States", 2016, "3", "weekly", 5.0), ("United States", 2012, "3", "weekly", 5.0)],
        "country_name string, year int, time string, time_unit string, deaths double",
    ).write.parquet(path)
    found = ingest.ingest_country_series(spark.read.parquet(path), rules)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(year,2015)" in plan and "LessThanOrEqual(year,2020)" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert found.count() == 1


def test_spellings_of_one_date_meet_across_three_rows(make, rows):
    frame = make(
        PROVISIONAL,
        [
            ("2020", "1", "2020-01-04", "New York", "1"),
            ("2020", "1", "01/04/2020", "New York City", "2"),
            ("2020", "1", "1/4/2020", "New York City", "4"),
            ("2020", "1", None, "New York", "8"),
            ("2020", "1", "soon", "New York", "16"),
        ],
    )
    got = rows(ingest.ingest_provisional(frame), "week_ending_date", "deaths")
    assert got == [("2020-01-04", 7.0), ("soon", 16.0), (None, 8.0)]
    assert len(rows(ingest.ingest_provisional(frame, PARITY))) == 5
