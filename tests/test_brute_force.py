"""The whole batch under parity rules against a plain-Python twin, on dirty random files."""

import csv
import datetime as dt
import math
import random

import pytest

from tallyweek.plans import compile as plans
from tallyweek.rules import PARITY
from tallyweek.schema import JURISDICTIONS
from tallyweek.sources.scan import population_from_dict, scan_landing

STATES = ["New York", "New York City", "Bronx NYC", "Ohio", "Texas", "United States", "US", "Total", "Guam", ""]
NUMBERS = ["12", " 7 ", "1,234", "", "nan", "1.0d", "0", "-3", "25.5", "3", "4", "5"]
POPULATION = {2014: {"Ohio": 900}, 2015: {"New York": 1000, "Texas": 0}, 2018: {"Ohio": 500, "United States": 9999}}


def dates(rng):
    day = dt.date(2019, 1, 1) + dt.timedelta(rng.randrange(30))
    return rng.choice(
        [day.isoformat(), f"{day.month}/{day.day}/{day.year}", f"{day.year}/{day.month}/{day.day}", "not a date", ""]
    )


def make_files(rng, folder, city):
    states = [s for s in STATES if city or ("NYC" not in s and "City" not in s)]
    week = lambda: rng.choice(["1", "2", "2", "3", "53", "54", "0", "0.5", "x", ""])
    tables = {
        "dated_file": (
            ["Week Ending Date", "Jurisdiction of Occurrence", "All Cause"],
            [[dates(rng), rng.choice(states), rng.choice(NUMBERS)] for _ in range(40)],
        ),
        "country_series": (
            ["country_name", "year", "time", "time_unit", "deaths"],
            [
                [rng.choice(["United States", "France"]), rng.choice(["2014", "2015", "2019", "2020", "2021", "x"]), week(),
                 rng.choice(["weekly", "monthly"]), rng.choice(NUMBERS)]
                for _ in range(30)
            ],
        ),
        "packed_week": (
            ["age", "MMWR Year/Week", "State", "All Deaths"],
            [
                [rng.choice(["All", "All", "18-64"]), rng.choice(["201501", "201501", "201502", "201852", "201901", "201854", "abc"]),
                 rng.choice(states), rng.choice(NUMBERS)]
                for _ in range(40)
            ],
        ),
        "provisional": (
            ["Year", "MMWR Week", "Week Ending Date", "State", "Total Deaths"],
            [
                [rng.choice(["2019", "2020", "2020", "2022", "2019/2020"]), week(), rng.choice(["d1", "d2", ""]),
                 rng.choice(states), rng.choice(NUMBERS)]
                for _ in range(60)
            ],
        ),
    }
    for name, (header, rows) in tables.items():
        (folder / name).mkdir(parents=True)
        with open(folder / name / "data.csv", "w", newline="") as out:
            csv.writer(out, quoting=csv.QUOTE_ALL).writerows([header, *rows])
    return {name: [dict(zip(header, map(blank, row))) for row in rows] for name, (header, rows) in tables.items()}


def blank(cell):
    return None if cell in ("", "nan") else cell


def num(cell):
    try:
        value = float(cell)
    except (TypeError, ValueError):
        return None
    return None if math.isnan(value) else value


def week_of(text):
    for pattern in ("%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d", "%d/%m/%Y"):
        try:
            day = dt.datetime.strptime(text or "", pattern).date()
        except ValueError:
            continue
        sundays = [dt.date(y, 1, d) for y in (day.year - 1, day.year) for d in range(1, 8)]
        start = max(s for s in sundays if s.weekday() == 6 and s <= day)
        return max(1, (day - start).days // 7 + 1 - 1)
    return None


def is_city(state):
    return state is not None and ("New York City" in state or "NYC" in state)


def fold(rows):
    names = {r["state"] for r in rows}
    if not any(map(is_city, names)):
        return rows
    renamed = [{**r, "state": "New York" if is_city(r["state"]) else r["state"]} for r in rows]
    if "New York" not in names:
        return renamed
    groups = {}
    for r in renamed:
        key = (r["year"], r["week"], r["state"], r.get("date"))
        groups[key] = groups.get(key, 0.0) + r["deaths"]
    # within one year, week and state only the date is left to order by
    by_key = sorted(groups.items(), key=lambda kv: (kv[0][3] is None, kv[0][3] or ""))
    return [dict(year=y, week=w, state=s, date=d, deaths=n) for (y, w, s, d), n in by_key]


def sources(raw):
    dated = [
        dict(year=2019, week=week_of(r["Week Ending Date"]), date=r["Week Ending Date"],
             state=r["Jurisdiction of Occurrence"], deaths=num(r["All Cause"]))
        for r in raw["dated_file"]
    ]
    yield fold([r for r in dated if (r["deaths"] or 0) > 0 and r["state"] not in ("United States", "US", "Total")])
    country = [
        dict(year=num(r["year"]), week=num(r["time"]), state="United States", deaths=num(r["deaths"]))
        for r in raw["country_series"]
        if r["country_name"] == "United States"
    ]
    yield [r for r in country if r["year"] is not None and 2015 <= r["year"] <= 2020]
    packed = [
        dict(year=num(r["MMWR Year/Week"]) // 100, week=num(r["MMWR Year/Week"]) % 100, state=r["State"],
             deaths=num(r["All Deaths"]))
        for r in raw["packed_week"]
        if r["age"] == "All" and num(r["MMWR Year/Week"]) is not None
    ]
    yield fold([r for r in packed if 2015 <= r["year"] <= 2018 and (r["deaths"] or 0) > 0 and 0 < r["week"] <= 53])
    provisional = [
        dict(year=num(r["Year"]), week=num(r["MMWR Week"]), date=r["Week Ending Date"], state=r["State"],
             deaths=num(r["Total Deaths"]))
        for r in raw["provisional"]
    ]
    yield fold(
        [r for r in provisional if (r["year"] or 0) >= 2020 and (r["deaths"] or 0) > 0 and 0 < (r["week"] or 0) <= 53]
    )


LABELS = ["Local 2019 File", "World Mortality Dataset", "Archived NCHS", "CDC Provisional"]


def compiled_by_hand(raw):
    best = {}
    for label, rows in zip(LABELS, sources(raw)):
        for r in rows:
            if None in (r["year"], r["state"], r["deaths"], r["week"]):
                continue
            key = (int(r["year"]), int(r["week"]), r["state"])
            score = 6 + (r.get("date") is not None)
            if key not in best or score > best[key][0]:
                best[key] = (score, r.get("date"), r["deaths"], label)
    out = []
    for (year, week, state), (_, date, deaths, label) in best.items():
        state = "New York" if state == "New York City" else state
        if state not in JURISDICTIONS or deaths <= 0:
            continue
        people = next((POPULATION[y][state] for y in range(year, year - 5, -1) if state in POPULATION.get(y, {})), None)
        rate = round(deaths / people * 100000 * 10) / 10 if people else None
        out.append((year, week, week, date, state, deaths, people, rate, label))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_batch(spark, tmp_path, rows, seed):
    raw = make_files(random.Random(seed), tmp_path, city=seed % 3 != 0)
    frames = {name: scan_landing(spark, str(tmp_path), name) for name in raw}
    facts = plans.compile_facts(frames, population_from_dict(spark, POPULATION), PARITY)
    expected = compiled_by_hand(raw)
    assert len(expected) > 10
    assert rows(facts) == expected
