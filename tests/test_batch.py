"""Rejected rows, malformed lines, editions and recompilation of what changed."""

import random

import pytest
from pyspark.sql import functions as F

from tallyweek.operators import combine, reject
from tallyweek.plans import batch
from tallyweek.plans import compile as plans
from tallyweek.plans.facts import SOURCES
from tallyweek.rules import DEFAULT, PARITY
from tallyweek.schema import SOURCE
from tallyweek.sources import publish
from tallyweek.sources.marks import MARKS, normalised
from tallyweek.sources.scan import MALFORMED, malformed_lines, population_from_dict, scan_compiled, scan_csv

NUMBERS = ["7", "0", "-3", "1,234", "", "nan", "inf", "x", " 12 ", "1.0d", "5.5", None]
STATES = ["Ohio", "Texas", "New York", "New York City", "Bronx NYC", "Guam", "United States", "Total", None]
DATES = ["2019-01-12", "1/12/2019", "2020/2/1", "soon", "", "13/02/2019", "2020-01-04T00:00:00Z", None]
YEARS = ["2014", "2015", "2018", "2020", "2021", "2019/2020", "2018.7", None]
WEEKS = ["0", "1", "5", "53", "54", "0.5", "99999999999", "", None]
LAYOUTS = {
    "dated_file": ("`Week Ending Date` string, `Jurisdiction of Occurrence` string, `All Cause` string", [DATES, STATES, NUMBERS]),
    "country_series": (
        "country_name string, year string, time string, time_unit string, deaths string",
        [["United States", "France", None], YEARS, WEEKS, ["weekly", "monthly", None], NUMBERS],
    ),
    "packed_week": (
        "age string, `MMWR Year/Week` string, State string, `All Deaths` string",
        [["All", "0-17", None], ["201501", "201853", "201854", "201900", "abc", "2018", None], STATES, NUMBERS],
    ),
    "provisional": (
        "Year string, `MMWR Week` string, `Week Ending Date` string, State string, `Total Deaths` string",
        [YEARS, WEEKS, DATES, STATES, NUMBERS],
    ),
}


def dirty(make, name, seed, n=400):
    draw = random.Random(seed)
    schema, values = LAYOUTS[name]
    rows = [tuple(draw.choice(v) for v in values) for _ in range(n)]
    frame = make(schema, rows)
    order = F.struct(F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"), F.monotonically_increasing_id().alias("position"))
    return frame.coalesce(1).withColumn("row_ord", order)


def same(left, right, rows):
    columns = [c for c in left.columns if c != "row_ord"]
    assert sorted(columns) == sorted(c for c in right.columns if c != "row_ord")
    assert rows(left, *columns) == rows(right, *columns)


@pytest.mark.parametrize("rules", [DEFAULT, PARITY], ids=["default", "parity"])
@pytest.mark.parametrize("name", sorted(MARKS))
def test_kept_rows_are_those_of_the_ingest(make, rows, name, rules):
    raw = dirty(make, name, 1)
    tagged = MARKS[name](raw, rules)
    assert tagged.count() == raw.count()
    same(normalised(name, reject.kept(tagged), rules), SOURCES[name](raw, rules), rows)
    lost = tagged.filter("reason IS NOT NULL")
    assert lost.filter("raw IS NULL").count() == 0 and reject.kept(tagged).filter("raw IS NOT NULL").count() == 0
    assert lost.select("reason").distinct().count() >= 2


@pytest.mark.parametrize("rules", [DEFAULT, PARITY], ids=["default", "parity"])
def test_kept_rows_are_those_of_the_cleaning(spark, make, rows, rules):
    sources = [SOURCES[name](dirty(make, name, 2, 3000), rules) for name in SOURCES]
    merged = combine.union_sources(sources)
    tagged = reject.mark_cleaning(merged, rules)
    assert tagged.count() == merged.count()
    clean = combine.clean(merged, rules)
    same(reject.kept(tagged).select(*clean.columns), clean, rows)
    reasons = {r.reason for r in tagged.select("reason").distinct().collect()}
    assert {None, reject.DATE_UNREAD, reject.NOT_WHOLE, reject.UNKNOWN_STATE, reject.DUPLICATE} - ({reject.NOT_WHOLE} if rules is DEFAULT else set()) <= reasons


def test_reasons_by_hand(make, rows):
    cells = "year double, week double, mmwr_week double, week_ending_date string, state string, deaths double, data_source string, source_ord int"
    merged = make(
        cells,
        [
            (2019.0, 2.0, 2.0, "2019-01-12", "Ohio", 5.0, "A", 0),
            (2019.0, 2.0, 2.0, None, "Ohio", 7.0, "B", 1),
            (2019.0, 2.0, 2.0, "2019-01-12", "Ohio", 5.0, "C", 2),
            (None, None, None, "soon", "Ohio", 1.0, "A", 0),
            (None, 3.0, 3.0, None, "Ohio", 1.0, "A", 0),
            (2019.0, 3.0, 3.0, None, None, 1.0, "A", 0),
            (2019.0, 3.0, 3.0, None, "Ohio", None, "A", 0),
            (2019.0, float("inf"), 3.0, None, "Ohio", 1.0, "A", 0),
            (2019.0, 3.0, 3.0, None, "Guam", 1.0, "A", 0),
            (2019.0, 3.0, 3.0, None, "Ohio", 0.0, "A", 0),
            (2019.0, 4.0, 4.0, None, "New York City", 2.0, "A", 0),
        ],
    )
    tagged = reject.mark_cleaning(merged)
    got = rows(tagged, "reason", "state", "deaths", "kept_source", "kept_deaths")
    assert got == sorted(
        [
            (None, "Ohio", 5.0, None, None),
            (reject.DUPLICATE, "Ohio", 7.0, "A", 5.0),
            (reject.DUPLICATE, "Ohio", 5.0, "A", 5.0),
            (reject.DATE_UNREAD, "Ohio", 1.0, None, None),
            (reject.NO_YEAR_OR_WEEK, "Ohio", 1.0, None, None),
            (reject.NO_STATE, None, 1.0, None, None),
            (reject.NO_COUNT, "Ohio", None, None, None),
            (reject.NOT_WHOLE, "Ohio", 1.0, None, None),
            (reject.UNKNOWN_STATE, "Guam", 1.0, None, None),
            (reject.NOT_POSITIVE, "Ohio", 0.0, None, None),
            (None, "New York", 2.0, None, None),
        ],
        key=repr,
    )
    assert rows(reject.source_conflicts(tagged)) == [("A", "B", 1, 0, 2.0), ("A", "C", 1, 1, 0.0)]
    assert reject.source_conflicts(reject.mark_cleaning(merged.limit(0))).count() == 0


def test_rows_without_a_key_are_no_hot_group(spark):
    merged = spark.range(0, 20_000, 1, 8).selectExpr(
        "CAST(NULL AS DOUBLE) year", "CAST(NULL AS DOUBLE) week", "CAST(NULL AS DOUBLE) mmwr_week", "'soon' week_ending_date",
        "'Ohio' state", "1.0D deaths", "'A' data_source", "0 source_ord",
    )
    tagged = reject.mark_cleaning(merged)
    largest = tagged.groupBy(F.spark_partition_id()).count().agg(F.max("count")).collect()[0][0]
    assert tagged.filter(F.col("reason") == reject.DATE_UNREAD).count() == 20_000 and largest < 10_000


# --- malformed lines ---------------------------------------------------------

LINES = """Year,MMWR Week,Week Ending Date,State,Total Deaths
2020,5,2020-02-01,Ohio,80
2020,6,2020-02-08,Ohio
2020,7,2020-02-15,Ohio,81,extra
2020,8,"2020-02-22,Ohio,82
2020,9,2020-02-29,"Ohio",83

2020,9,2020-02-29,"Te""xas",84
"""
BROKEN = ["2020,6,2020-02-08,Ohio", "2020,7,2020-02-15,Ohio,81,extra", '2020,8,"2020-02-22,Ohio,82']
POPULATION = {2018: {"Ohio": 1000}, 2019: {"Ohio": 1000}, 2020: {"Ohio": 1000, "Texas": 2000}}


@pytest.fixture
def place(tmp_path):
    def write(name, text):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)

    write.out = str(tmp_path / "out")
    write.landing = str(tmp_path / "in")
    return write


def run(spark, place, rules=DEFAULT, out=None, **options):
    population = options.pop("population", POPULATION)
    return plans.compile_landing(spark, place.landing, population_from_dict(spark, population), out or place.out, rules, **options)


def test_rescued_lines(spark, place, rows):
    place("provisional/a.csv", LINES)
    scanned = scan_csv(spark, f"{place.landing}/provisional", rescue=True)
    assert scanned.count() == 6 and rows(malformed_lines(scanned)) == sorted(zip(BROKEN, (4, 5, 3), (1, 1, 1)))
    # also where other columns alone are read
    assert scanned.filter(F.col(MALFORMED).isNull()).select("Year").count() == 3
    assert MALFORMED not in scan_csv(spark, f"{place.landing}/provisional").columns


def test_malformed_lines_are_dropped_kept_or_refused(spark, place, rows):
    from dataclasses import replace

    from pyspark.errors import PySparkException

    place("provisional/a.csv", LINES)
    written = run(spark, place)
    assert rows(scan_compiled(spark, written["states"]), "week", "deaths") == [(5, 80.0), (9, 83.0)]
    assert ("provisional", "normalise", reject.MALFORMED_LINE, "3") in rows(scan_csv(spark, written["rejects"]))
    found = plans.rejected_rows(spark, place.out).filter(F.col("reason") == reject.MALFORMED_LINE)
    assert sorted(r.raw for r in found.collect()) == sorted(BROKEN)
    assert all(r.file.endswith("provisional/a.csv") and r.source == "provisional" for r in found.collect())
    written = run(spark, place, replace(DEFAULT, malformed="keep"))
    assert rows(scan_compiled(spark, written["states"]), "week", "deaths") == [(5, 80.0), (7, 81.0), (9, 83.0)]
    with pytest.raises(PySparkException, match="malformed line"):
        run(spark, place, replace(DEFAULT, malformed="fail"))
    # the edition before the failure is still there
    assert scan_compiled(spark, f"{place.out}/states").count() == 3
    with pytest.raises(ValueError):
        run(spark, place, replace(DEFAULT, malformed="perhaps"))


# --- what leaves, adds up ----------------------------------------------------


def dirty_landing(place, seed=7, n=250):
    draw = random.Random(seed)
    for name, (schema, values) in LAYOUTS.items():
        header = ",".join(column.rsplit(" ", 1)[0].strip().strip("`") for column in schema.split(", "))
        lines = [",".join('"' + (draw.choice(v) or "") + '"' for v in values) for _ in range(n)]
        place(f"{name}/a.csv", "\n".join([header, *lines, "short"]) + "\n")


@pytest.mark.parametrize("rules", [DEFAULT, PARITY], ids=["default", "parity"])
def test_rejects_and_counts_add_up(spark, place, rows, rules):
    dirty_landing(place)
    written = run(spark, place, rules)
    counts = {r.stage: int(r.rows) for r in scan_csv(spark, written["counts"]).collect()}
    rejects = [(r.source, r.stage, r.reason, int(r.rows)) for r in scan_csv(spark, written["rejects"]).collect()]
    lost = lambda source, *stages: sum(n for s, stage, _, n in rejects if s == source and stage in stages)
    for name in SOURCES:
        assert counts[f"{name} read"] == 251
        assert counts[f"{name} read"] - lost(name, "normalise", "fold") == counts[f"{name} normalised"]
    assert sum(counts[f"{name} normalised"] - lost(name, "clean") for name in SOURCES) == counts["cleaned"]
    assert counts["cleaned"] == scan_compiled(spark, written["compiled"], "parquet").count() > 20
    assert ("malformed line" in {r[2] for r in rejects}) == (rules is DEFAULT)
    # the rows behind the numbers, and the facts of the plan that tags nothing
    detail = plans.rejected_rows(spark, place.out).groupBy("source", "stage", "reason").count()
    assert sorted(map(tuple, detail.collect())) == sorted(r for r in rejects if r[1] != "fold")
    raw = {name: scan_csv(spark, f"{place.landing}/{name}", row_order=True, rescue=rules is DEFAULT) for name in SOURCES}
    if rules is DEFAULT:
        raw = {name: frame.filter(F.col(MALFORMED).isNull()).drop(MALFORMED) for name, frame in raw.items()}
    plain = plans.compile_facts(raw, population_from_dict(spark, POPULATION), rules)
    same(scan_compiled(spark, written["compiled"], "parquet"), plain, rows)


# --- editions ----------------------------------------------------------------


def provisional(*cells):
    lines = [f"{year},{week},,{state},{deaths}" for year, week, state, deaths in cells]
    return "\n".join(["Year,MMWR Week,Week Ending Date,State,Total Deaths", *lines]) + "\n"


def everything(spark, out, rows):
    names = ("national", "states")
    return [rows(scan_compiled(spark, f"{out}/compiled", "parquet"))] + [rows(scan_compiled(spark, f"{out}/{name}")) for name in names]


@pytest.mark.parametrize("step, changed_only", [("write_extracts", False), ("_write_counts", True), ("publish", True)])
def test_a_failing_batch_changes_nothing(spark, place, rows, monkeypatch, step, changed_only):
    place("provisional/a.csv", provisional((2020, 1, "Ohio", 5), (2021, 1, "United States", 50)))
    run(spark, place)
    before, edition = everything(spark, place.out, rows), publish.latest(spark, place.out)
    place("provisional/a.csv", provisional((2020, 1, "Ohio", 6), (2020, 2, "Texas", 1)))

    def fail(*_args):
        raise OSError("disk full")

    with monkeypatch.context() as patched:
        patched.setattr(batch, step, fail)
        with pytest.raises(OSError):
            run(spark, place, changed_only=changed_only)
    assert everything(spark, place.out, rows) == before and publish.latest(spark, place.out) == edition
    run(spark, place)
    compiled, national, states = everything(spark, place.out, rows)
    assert [r[5] for r in compiled] == [6.0, 1.0] and national == [] and states == compiled
    assert publish.latest(spark, place.out).number == edition.number + 1


def test_written_folders_stay_as_they_were(spark, place, rows):
    """A reader that resolved its folders before the switch reads the run it began with."""
    place("provisional/a.csv", provisional((2020, 1, "Ohio", 5)))
    first = run(spark, place)
    old = scan_compiled(spark, f"{place.out}/compiled", "parquet")
    place("provisional/a.csv", provisional((2020, 1, "Ohio", 6)))
    second = run(spark, place)
    assert rows(old, "deaths") == rows(scan_compiled(spark, first["states"]), "deaths") == [(5.0,)]
    assert rows(scan_compiled(spark, second["states"]), "deaths") == [(6.0,)]


def partition_files(edition, out):
    from pathlib import Path

    found = {}
    for year, folder in edition.tables["compiled"].items():
        found[year] = {(p.name, p.stat().st_mtime_ns) for p in Path(out, folder).glob("*.parquet")}
    return found


def test_only_touched_years_are_compiled_again(spark, place, rows, monkeypatch, tmp_path):
    place("provisional/a.csv", provisional((2020, 1, "Ohio", 5), (2021, 1, "Ohio", 6), (2020, 1, "New York City", 1)))
    place("provisional/b.csv", provisional((2021, 1, "Ohio", 7), (2022, 1, "Ohio", 8), (2020, 1, "New York", 2)))
    place("packed_week/p.csv", "age,MMWR Year/Week,State,All Deaths\nAll,201801,Ohio,9\nAll,x,Ohio,9\n")
    place("dated_file/d.csv", "Week Ending Date,Jurisdiction,Deaths\n2019-01-12,Ohio,3\nsoon,Ohio,4\n")
    run(spark, place)
    first = publish.latest(spark, place.out)
    landed = []
    real = batch.scan_csv
    monkeypatch.setattr(batch, "scan_csv", lambda spark, paths, **o: landed.extend(paths) or real(spark, paths, **o))

    def again(expected_files, touched):
        before, edition = partition_files(publish.latest(spark, place.out), place.out), publish.latest(spark, place.out)
        landed.clear()
        run(spark, place, changed_only=True)
        after, now = partition_files(publish.latest(spark, place.out), place.out), publish.latest(spark, place.out)
        assert sorted(p.rsplit("/", 1)[1] for p in landed) == expected_files
        changed = {y for y in before.keys() | after.keys() if now.tables["compiled"].get(y) != edition.tables["compiled"].get(y)}
        assert changed == touched
        assert all(before[y] == after[y] for y in before if y not in touched)
        # the same as a full run elsewhere
        other = str(tmp_path / f"full{now.number}")
        full = run(spark, place, out=other)
        assert everything(spark, place.out, rows) == everything(spark, other, rows)
        resolved = batch.places(now, place.out)
        for table in ("counts", "rejects"):
            assert rows(scan_csv(spark, resolved[table])) == rows(scan_csv(spark, full[table]))

    # nothing changed
    again([], set())
    # a revised file: 2021 is fed by the other file too, 2020 loses a row
    place("provisional/a.csv", provisional((2021, 1, "Ohio", 60), (2021, 2, "Texas", 1), (2020, 1, "New York City", 1)))
    again(["a.csv"], {"2020", "2021"})
    # a new file
    place("provisional/c.csv", provisional((2022, 1, "Ohio", 1), (2023, 1, "Ohio", 1)))
    again(["c.csv"], {"2022", "2023"})
    # a file that is gone takes a year with it; the undated row of another file stays rejected
    import os

    os.remove(f"{place.landing}/packed_week/p.csv")
    again([], {"2018"})
    assert publish.latest(spark, place.out).number == first.number + 4
    # another population: all years
    place("provisional/c.csv", provisional((2022, 1, "Ohio", 2)))
    run(spark, place, changed_only=True, population={2020: {"Ohio": 10}})
    folders = publish.latest(spark, place.out).tables["compiled"].values()
    assert {f.rsplit("run=")[1] for f in folders} == {publish.latest(spark, place.out).run}
    assert rows(scan_compiled(spark, f"{place.out}/compiled", "parquet").filter("population IS NOT NULL").select("population").distinct()) == [(10,)]


def test_rules_that_need_all_data_run_in_full(spark, place):
    place("provisional/a.csv", provisional((2020, 1, "Ohio", 5)))
    place("packed_week/p.csv", "age,MMWR Year/Week,State,All Deaths\nAll,201801,Ohio,9\n")
    run(spark, place, PARITY)
    place("provisional/a.csv", provisional((2020, 1, "Ohio", 6)))
    run(spark, place, PARITY, changed_only=True)
    edition = publish.latest(spark, place.out)
    assert {f.rsplit("run=")[1] for f in edition.tables["compiled"].values()} == {edition.run}


def test_an_empty_edition(spark, place):
    written = run(spark, place)
    assert scan_compiled(spark, f"{place.out}/compiled", "parquet").count() == 0
    assert scan_compiled(spark, written["national"]).count() == 0
    assert plans.rejected_rows(spark, place.out).count() == 0
    assert plans.rejected_rows(spark, place.landing) is None


def test_marks_have_the_layout_of_the_table():
    from tallyweek.sources.marks import marked_layout

    assert marked_layout(None).fieldNames() == [*SOURCE.fieldNames(), "reason", "raw"]
