"""The whole batch, from landed files to outputs and reports."""

import pytest

from tallyweek.plans import compile as plans
from tallyweek.rules import PARITY
from tallyweek.schema import FACT, FACT_COLUMNS
from tallyweek.sources.scan import population_from_dict, scan_compiled, scan_csv

FILES = {
    "dated_file/a.csv": """Week Ending Date,Jurisdiction of Occurrence,All Cause
2019-01-12,New York,100
1/12/2019,New York City,50
2019-01-12,Ohio,70
2019-01-12,United States,999
""",
    "country_series/w.csv": """iso3c,country_name,year,time,time_unit,deaths
USA,United States,2019,2,weekly,5000
USA,United States,2020,5,weekly,6000
FRA,France,2020,5,weekly,1
""",
    "packed_week/p.csv": """age,MMWR Year/Week,State,All Deaths
All,201802,New York,90
All,201802,New York City,40
All,201802,Ohio,"1,000"
All,201802,Texas,60
""",
    "provisional/c.csv": """Year,MMWR Week,Week Ending Date,State,Total Deaths
2020,5,02/01/2020,United States,6100
2020,5,02/01/2020,Ohio,80
2020,5,02/01/2020,Guam,8
2020,5,02/01/2020,Ohio,90
""",
}
POPULATION = {2018: {"New York": 1000, "Texas": 2000, "United States": 100000}, 2019: {"New York": 1100, "Ohio": 500}}


@pytest.fixture
def landing(tmp_path):
    for name, text in FILES.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return tmp_path


def compiled(spark, landing, rules=None):
    population = population_from_dict(spark, POPULATION)
    args = (spark, str(landing / "in"), population, str(landing / "out"))
    return plans.compile_landing(*args) if rules is None else plans.compile_landing(*args, rules)


def test_outputs(spark, landing, rows):
    written = compiled(spark, landing)
    national = scan_compiled(spark, written["national"])
    states = scan_compiled(spark, written["states"])
    assert national.columns == states.columns == FACT_COLUMNS
    assert [f.dataType for f in national.schema] == [f.dataType for f in FACT]
    assert rows(national) == [
        (2019, 2, 2, None, "United States", 5000.0, 100000, 5000.0, "World Mortality Dataset"),
        (2020, 5, 5, "2020-02-01", "United States", 6100.0, 100000, 6100.0, "CDC Provisional"),
    ]
    assert rows(states) == [
        (2018, 2, 2, None, "New York", 130.0, 1000, 13000.0, "Archived NCHS"),
        (2018, 2, 2, None, "Texas", 60.0, 2000, 3000.0, "Archived NCHS"),
        (2019, 2, 2, "2019-01-12", "New York", 150.0, 1100, 13636.4, "Local 2019 File"),
        (2019, 2, 2, "2019-01-12", "Ohio", 70.0, 500, 14000.0, "Local 2019 File"),
        # two rows of one key are summed, whether or not the file has a city
        (2020, 5, 5, "2020-02-01", "Ohio", 170.0, 500, 34000.0, "CDC Provisional"),
    ]


def test_parity(spark, landing, rows):
    written = compiled(spark, landing, PARITY)
    states = scan_compiled(spark, written["states"])
    got = rows(states.filter("year = 2019"), "week", "state", "deaths", "week_ending_date")
    # weeks off by two, and the two date spellings of New York do not meet
    assert got == [(1, "New York", 50.0, "1/12/2019"), (1, "Ohio", 70.0, "2019-01-12")]


def test_absent_sources(spark, landing):
    written = compiled(spark, landing / "nothing-here")
    assert scan_compiled(spark, written["states"]).count() == 0
    assert {r.rows for r in scan_csv(spark, written["counts"]).collect()} == {"0"}


def test_an_extract_that_becomes_empty_leaves_no_rows(spark, landing):
    assert scan_compiled(spark, compiled(spark, landing)["national"]).count() == 2
    for name in ("country_series", "provisional"):
        for file in (landing / "in" / name).iterdir():
            file.write_text(file.read_text().replace("United States", "Ohio"))
    written = compiled(spark, landing)
    assert scan_compiled(spark, written["national"]).count() == 0
    assert scan_compiled(spark, written["states"]).count() > 0


@pytest.mark.parametrize("rules", [None, PARITY], ids=["default", "parity"])
def test_counts_and_reports_are_written(spark, landing, rules):
    (landing / "in" / "packed_week" / "p.csv").write_text("MMWR Year/Week,State,All Deaths\n201802,Ohio,5\n")
    written = compiled(spark, landing, rules)
    counts = {r.stage: int(r.rows) for r in scan_csv(spark, written["counts"]).collect()}
    assert counts["dated_file read"] == 4 and counts["country_series read"] == 3
    assert counts["packed_week read"] == counts["packed_week normalised"] == 0
    assert counts["provisional normalised"] == (4 if rules else 3)
    assert counts["cleaned"] == scan_compiled(spark, written["compiled"], "parquet").count()
    for name in plans.reports(scan_compiled(spark, written["compiled"], "parquet")):
        assert name in written
    assert spark.read.json(written["validation"]).count() <= 2
    assert spark.read.json(written["national_summary"]).count() == 1


def test_quoted_line_breaks(spark, landing):
    (landing / "in" / "dated_file" / "a.csv").write_text('Week Ending Date,Jurisdiction of Occurrence,All Cause,Note\n2019-01-12,Ohio,70,"a\nb"\n')
    population = population_from_dict(spark, POPULATION)
    written = plans.compile_landing(spark, str(landing / "in"), population, str(landing / "out"), multiline=True)
    assert scan_compiled(spark, written["states"]).filter("year = 2019").count() == 1


def test_no_source_at_all(spark):
    facts = plans.compile_facts({}, population_from_dict(spark, POPULATION))
    assert facts.columns == FACT_COLUMNS and facts.count() == 0


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        plans.compile_facts({"fax": None}, population_from_dict(spark, POPULATION))


def test_reports_and_chart(spark, landing, rows):
    facts = scan_compiled(spark, compiled(spark, landing)["compiled"], "parquet")
    got = {name: [tuple(r) for r in frame.collect()] for name, frame in plans.reports(facts).items()}
    assert got["national_population"] == [(2, 2, 100.0, 0)]
    assert sorted(got["coverage_diff"]) == [("Ohio", "new in 2019"), ("Texas", "missing in 2019")]
    assert [r[0] for r in got["top_changes"]] == ["New York", "Ohio"]
    assert {r[0] for r in got["validation"]} == {"entity", "overall"}
    assert got["state_coverage"] == [(2, 0, 1.0)]
    points, ends = plans.chart(facts, "raw", ["New York"])
    assert rows(points) == [(2018, 2, 130.0, "New York"), (2019, 2, 150.0, "New York")]
    assert rows(ends, "year", "value", "period") == [(2018, 130.0, "baseline"), (2019, 150.0, "baseline")]
