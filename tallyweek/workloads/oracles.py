"""The same queries as ANSI-style SQL, written independently of the operators.

Week numbers come from first-Sunday and 4 January arithmetic, the as-of lookup
from a correlated subquery, the set operations from real joins.
"""

from __future__ import annotations

from tallyweek.workloads.views import EVENT_NAMES, FACT_NAMES, FOLD_NAMES, SOURCE_NAMES
from tallyweek.schema import JURISDICTIONS


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


def six(expression: str, name: str) -> str:
    return f"round_even(CAST({expression} AS DOUBLE) * 1000000, 0) / 1000000 AS {name}"


def first_sunday(year: str) -> str:
    return f"(make_date({year}, 1, 1) + CAST((7 - dayofweek(make_date({year}, 1, 1))) % 7 AS INT))"


def sunday_year(day: str) -> str:
    return f"(CASE WHEN {day} >= {first_sunday(f'year({day})')} THEN year({day}) ELSE year({day}) - 1 END)"


def sunday_week(day: str) -> str:
    return f"(date_diff('day', {first_sunday(sunday_year(day))}, {day}) // 7 + 1)"


def mmwr_start(year: str) -> str:
    return f"(make_date({year}, 1, 4) - CAST(dayofweek(make_date({year}, 1, 4)) AS INT))"


def mmwr_year(day: str) -> str:
    return (
        f"(CASE WHEN {day} >= {mmwr_start(f'year({day}) + 1')} THEN year({day}) + 1 "
        f"WHEN {day} >= {mmwr_start(f'year({day})')} THEN year({day}) ELSE year({day}) - 1 END)"
    )


def mmwr_week(day: str) -> str:
    return f"(date_diff('day', {mmwr_start(mmwr_year(day))}, {day}) // 7 + 1)"


DAYS = "days AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)"

W = f"""{DAYS},
numbered AS (
  SELECT o_custkey, day, {sunday_year('day')} AS y, {sunday_week('day')} AS wk,
         day + CAST(6 - dayofweek(day) AS INT) AS saturday
  FROM days),
w AS (
  SELECT c_nationkey AS nk, n_name AS state, CAST(y + 20 AS INT) AS year, CAST(wk AS INT) AS week,
         CAST(wk AS INT) AS mmwr_week, strftime(max(saturday), '%Y-%m-%d') AS week_ending_date,
         CAST(count(*) AS BIGINT) AS deaths
  FROM numbered JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY c_nationkey, n_name, y, wk)"""

FACTS = f"""{W},
f AS (SELECT nk, {_list(FACT_NAMES)}[nk + 1] AS state, year, week, mmwr_week, week_ending_date, deaths FROM w)"""

POP_ONLY = """pop AS (
  SELECT nk, n_name AS state, CAST(y AS INT) AS year, CAST(c * 1000 + (y - 2015) * 10 AS BIGINT) AS population
  FROM (SELECT c_nationkey AS nk, count(*) AS c FROM customer GROUP BY c_nationkey) counts
  JOIN nation ON nk = n_nationkey
  JOIN (SELECT unnest(range(2015, 2022)) AS y) years ON (nk + y) % 3 <> 0 AND NOT (nk = 24 AND y > 2015))"""

FACT_POP = f"""{POP_ONLY},
fpop AS (SELECT nk, {_list(FACT_NAMES)}[nk + 1] AS state, year, population FROM pop)"""


def asof(facts: str, dimension: str, name: str) -> str:
    return f"""{name} AS (
  SELECT x.*, (SELECT arg_max(p.population, p.year) FROM {dimension} p
               WHERE p.state = x.state AND p.year BETWEEN x.year - 4 AND x.year) AS population
  FROM {facts} x)"""


FP = f"{FACTS}, {FACT_POP}, {asof('f', 'fpop', 'fp')}"


def baselines(source: str, name: str = "b") -> str:
    return f"""{name}_avg AS (SELECT state, mmwr_week, avg(deaths) AS avg_2015_2019 FROM {source}
  WHERE year BETWEEN 2015 AND 2019 GROUP BY state, mmwr_week),
{name}_one AS (SELECT state, mmwr_week, avg(deaths) AS baseline_2015 FROM {source}
  WHERE year = 2015 GROUP BY state, mmwr_week),
{name} AS (
  SELECT x.*, avg_2015_2019, baseline_2015, x.year - 2015 AS years_from_2015,
         pow(1.0131::DOUBLE, x.year - 2015) AS growth_factor,
         baseline_2015 * pow(1.0131::DOUBLE, x.year - 2015) AS expected_deaths,
         x.deaths - avg_2015_2019 AS deviation_from_avg,
         x.deaths - baseline_2015 * pow(1.0131::DOUBLE, x.year - 2015) AS deviation_from_expected
  FROM {source} x LEFT JOIN {name}_avg USING (state, mmwr_week) LEFT JOIN {name}_one USING (state, mmwr_week))"""


FOLD_CASE = "CASE nk " + " ".join(f"WHEN {k} THEN {_text(v)}" for k, v in FOLD_NAMES.items()) + " ELSE state END"
FOLD = f"""{W},
fo AS (SELECT nk, {FOLD_CASE} AS state, year, week, mmwr_week, week_ending_date, deaths FROM w)"""
IS_CITY = "(state LIKE '%New York City%' OR state LIKE '%NYC%')"

AB = f"""{W},
ab AS (
  SELECT 0 AS source_ord, year, week, mmwr_week, week_ending_date, state, deaths, 'A' AS data_source, nk
  FROM w WHERE nk % 2 = 0
  UNION ALL
  SELECT 1, year, week, mmwr_week, CASE WHEN nk % 6 = 0 THEN week_ending_date END, state, deaths * 10, 'B', nk FROM w)"""
BEST = f"""{AB},
best AS (
  SELECT * FROM ab QUALIFY row_number() OVER (
    PARTITION BY year, week, state
    ORDER BY CASE WHEN week_ending_date IS NULL THEN 1 ELSE 0 END, source_ord) = 1)"""

UNEVEN = f"""{FACTS},
u AS (SELECT * FROM f WHERE NOT (nk = 5 AND year = 2019) AND NOT (nk = 6 AND year = 2018))"""

NUMBER = """CASE event_id % 7 WHEN 0 THEN '1,234' WHEN 1 THEN ' 12 ' WHEN 2 THEN '2019/2020' WHEN 3 THEN ''
    WHEN 4 THEN 'nan' WHEN 5 THEN '1.0d' ELSE CAST(event_id AS VARCHAR) END"""
DATE = """CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%-m/%-d/%Y')
    WHEN 2 THEN strftime(ts, '%Y/%-m/%-d') ELSE strftime(ts, '%-d/%-m/%Y') END"""
# yyyy-MM-dd, M/d/yyyy, ... as in views.SPELLINGS; the last is not a date
SPELLED = ["%Y-%m-%d", "%-m/%-d/%Y", "%Y/%-m/%-d", "%-d/%-m/%Y", "%Y%m%d", "%d-%b-%Y", "%m-%d-%Y", "%-d %B %Y", "%b %-d %Y",
           "%B %-d, %Y", "%Y.%m.%d", "%-m/%-d/%y", "%A, %B %-d, %Y", "%Y-%m-%dT%H:%M:%S", "week %-d of %Y"]
ANY_DATE = "CASE event_id % 15 " + " ".join(f"WHEN {n} THEN strftime(ts::DATE, '{p}')" for n, p in enumerate(SPELLED)) + " END"
# 13/02/2019 can only be day first; all that could be month first is
ANY_PARSED = """CASE WHEN event_id % 15 = 14 THEN NULL
    WHEN event_id % 15 = 3 AND day(ts) <= 12 THEN make_date(year(ts), day(ts), month(ts)) ELSE ts::DATE END"""
EVENTS = f"""ev AS (
  SELECT event_id, ts, {_list(EVENT_NAMES)}[user_id % 8 + 1] AS label, {NUMBER} AS number, {DATE} AS date,
         CAST(2014 + event_id % 8 AS INT) AS year, CAST(event_id % 56 AS INT) AS week
  FROM events)"""

# the dated file: a third of the events lies five years back
MOVED = "(ts::DATE - CASE WHEN event_id % 3 = 0 THEN 1827 ELSE 0 END)"
BACK = f"back AS (SELECT * REPLACE ({DATE.replace('ts', MOVED)} AS date) FROM ev)"


def number(text: str) -> str:
    return f"(CASE WHEN isnan(try_cast(trim({text}) AS DOUBLE)) THEN NULL ELSE try_cast(trim({text}) AS DOUBLE) END)"


def parsed(text: str) -> str:
    return f"CAST(try_strptime({text}, ['%Y-%m-%d', '%m/%d/%Y', '%Y/%m/%d', '%d/%m/%Y']) AS DATE)"


def folded(source: str, name: str) -> str:
    """Parent and child both occur in the event labels, so rows are summed."""
    return f"""{name} AS (
  SELECT year, week, mmwr_week, week_ending_date,
         CASE WHEN {IS_CITY} THEN 'New York' ELSE state END AS state, data_source, sum(deaths) AS deaths
  FROM {source} GROUP BY ALL)"""


def state_years(source: str) -> str:
    return f"""t18 AS (SELECT state, CAST(sum(deaths) AS BIGINT) AS total_before FROM {source}
  WHERE year = 2018 AND state <> 'United States' GROUP BY state),
t19 AS (SELECT state, CAST(sum(deaths) AS BIGINT) AS total_after FROM {source}
  WHERE year = 2019 AND state <> 'United States' GROUP BY state)"""


CHANGE = "(total_after - total_before) / CAST(total_before AS DOUBLE) * 100"

ORACLES: dict[str, str] = {}


def oracle(name: str, ctes: str, body: str) -> None:
    ORACLES[name] = (f"WITH {ctes}\n" if ctes else "") + body.strip()


oracle(
    "epi_week",
    DAYS,
    f"""SELECT day, CAST(count(*) AS BIGINT) AS n, day + CAST(6 - dayofweek(day) AS INT) AS saturday,
       CAST({sunday_year('day')} AS INT) AS sunday_year, CAST({sunday_week('day')} AS INT) AS sunday_week,
       CAST({mmwr_year('day')} AS INT) AS mmwr_year, CAST({mmwr_week('day')} AS INT) AS mmwr_week
FROM days GROUP BY day""",
)
oracle(
    "shift_weeks",
    W,
    """SELECT year, week, CASE WHEN week <= 1 THEN 1 ELSE week - 1 END AS shifted, CAST(sum(deaths) AS BIGINT) AS deaths
FROM w GROUP BY year, week""",
)
oracle(
    "week_range",
    W,
    """SELECT min(CASE WHEN week <= 1 THEN 1 ELSE week - 1 END) AS first_week,
       max(CASE WHEN week <= 1 THEN 1 ELSE week - 1 END) AS last_week FROM w""",
)
oracle(
    "parse_dates",
    f"p AS (SELECT event_id, {ANY_DATE} AS date, {ANY_PARSED} AS parsed FROM events)",
    f"""SELECT event_id, date, parsed, CAST({sunday_year('parsed')} AS INT) AS year,
       CAST({sunday_week('parsed')} AS INT) AS week FROM p""",
)
oracle(
    "unparsed_dates",
    "",
    f"SELECT {ANY_DATE} AS text, CAST(count(*) AS BIGINT) AS rows FROM events WHERE event_id % 15 = 14 GROUP BY 1",
)
oracle(
    "coerce_numeric",
    EVENTS,
    f"""SELECT event_id, CASE WHEN number LIKE '%d' THEN NULL ELSE {number('number')} END AS strict,
       CASE WHEN number LIKE '%d' THEN NULL ELSE {number("replace(number, ',', '')")} END AS lenient FROM ev""",
)
oracle(
    "split_year_week",
    EVENTS,
    """SELECT CASE WHEN event_id % 11 <> 0 THEN (year * 100 + week) // 100 END AS year,
       CASE WHEN event_id % 11 <> 0 THEN (year * 100 + week) % 100 END AS week, CAST(count(*) AS BIGINT) AS n
FROM ev GROUP BY 1, 2""",
)
oracle(
    "discover_columns",
    f"{EVENTS}, {BACK}",
    """SELECT date AS week_ending_date, label AS state, number AS deaths, CAST(count(*) AS BIGINT) AS n
FROM back GROUP BY date, label, number""",
)
oracle(
    "valid_measure",
    EVENTS,
    f"""SELECT event_id, {number('number')} AS deaths FROM ev
WHERE event_id % 7 <> 5 AND {number('number')} > 0""",
)
oracle(
    "valid_week",
    EVENTS,
    """SELECT CAST(week AS DOUBLE) AS week, CAST(count(*) AS BIGINT) AS n FROM ev
WHERE event_id % 13 <> 0 AND week BETWEEN 1 AND 53 GROUP BY week""",
)
oracle(
    "exclude_totals",
    EVENTS,
    """SELECT label AS state, CAST(count(*) AS BIGINT) AS n FROM ev
WHERE label IS NULL OR label NOT IN ('United States', 'US', 'USA', 'National', 'Total') GROUP BY label""",
)
oracle(
    "valid_jurisdictions",
    EVENTS,
    f"""SELECT label AS state, CAST(count(*) AS BIGINT) AS n FROM ev
WHERE label IN {_in(JURISDICTIONS)} GROUP BY label""",
)
oracle(
    "filter_country",
    "",
    """SELECT 'United States' AS country_name, CASE WHEN event_id % 5 = 0 THEN 'monthly' ELSE 'weekly' END AS time_unit,
       CAST(count(*) AS BIGINT) AS n FROM events WHERE event_id % 3 <> 0 GROUP BY 2""",
)
oracle(
    "split_national_state",
    FOLD,
    """SELECT CASE WHEN state = 'United States' THEN 'national' ELSE 'state' END AS side,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(deaths) AS BIGINT) AS deaths FROM fo GROUP BY 1""",
)
oracle(
    "select_states",
    FACTS,
    """SELECT 'All States, Ohio, Alabama' AS selection, year, CAST(sum(deaths) AS BIGINT) AS deaths
FROM f WHERE state IN ('Ohio', 'Alabama') GROUP BY year""",
)
oracle(
    "select_all_states",
    FACTS,
    "SELECT 'All States Combined' AS selection, year, CAST(sum(deaths) AS BIGINT) AS deaths FROM f GROUP BY year",
)
oracle(
    "state_choices",
    W,
    """SELECT 0 AS rank, 'All States' AS state UNION ALL SELECT 1, state FROM (SELECT DISTINCT state FROM w)""",
)
oracle(
    "fold_entities",
    FOLD,
    f"""SELECT CASE WHEN {IS_CITY} THEN 'New York' ELSE state END AS state, year, week, mmwr_week, week_ending_date,
       CAST(sum(deaths) AS BIGINT) AS deaths
FROM fo GROUP BY 1, 2, 3, 4, 5""",
)
LABELLED = f"""{EVENTS},
e AS (SELECT year, week, label AS state, CASE WHEN event_id % 7 <> 5 THEN {number('number')} END AS deaths FROM ev)"""
oracle(
    "fold_city_only",
    LABELLED,
    f"""SELECT year, CASE WHEN {IS_CITY} THEN 'New York' ELSE state END AS state, CAST(count(*) AS BIGINT) AS n,
       sum(deaths) AS deaths
FROM e WHERE state IS NULL OR state <> 'New York' GROUP BY 1, 2""",
)
oracle(
    "fold_state_only",
    LABELLED,
    f"""SELECT year, state, CAST(count(*) AS BIGINT) AS n, sum(deaths) AS deaths
FROM e WHERE state IS NULL OR NOT {IS_CITY} GROUP BY 1, 2""",
)
oracle(
    "fold_both",
    LABELLED
    + f""", g AS (SELECT year, week, CASE WHEN {IS_CITY} THEN 'New York' ELSE state END AS state,
  coalesce(sum(deaths), 0) AS deaths FROM e GROUP BY 1, 2, 3)""",
    "SELECT year, state, CAST(count(*) AS BIGINT) AS n, sum(deaths) AS deaths FROM g GROUP BY 1, 2",
)
oracle(
    "fold_stray_city",
    LABELLED,
    """SELECT year, week, state, coalesce(sum(deaths), 0) AS deaths FROM e WHERE state = 'Ohio' GROUP BY year, week, state""",
)
oracle(
    "first_per_entity",
    FOLD,
    """SELECT state, arg_min(week_ending_date, (year, week, nk)) FILTER (WHERE week > 10) AS week_ending_date
FROM fo GROUP BY state""",
)
oracle(
    "attach_first",
    FOLD
    + """, firsts AS (SELECT state, arg_min(week_ending_date, (year, week, nk)) FILTER (WHERE week > 10) AS first_date
  FROM fo GROUP BY state)""",
    """SELECT state, year, CAST(sum(deaths) AS BIGINT) AS deaths, any_value(first_date) AS first_date
FROM fo JOIN firsts USING (state) GROUP BY state, year""",
)
oracle(
    "national_rollup",
    W,
    """SELECT year, week, mmwr_week, arg_min(week_ending_date, state) FILTER (WHERE nk % 2 <> 0) AS week_ending_date,
       'United States' AS state, CAST(sum(deaths) AS BIGINT) AS deaths, 'Calculated from State Data' AS data_source
FROM w GROUP BY year, week, mmwr_week""",
)
oracle(
    "union_sources",
    AB,
    # the absent middle source still takes its place in the order
    """SELECT CASE source_ord WHEN 1 THEN 2 ELSE 0 END AS source_ord, data_source, year, CAST(count(*) AS BIGINT) AS n,
       CAST(count(week_ending_date) AS BIGINT) AS dated, CAST(sum(deaths) AS BIGINT) AS deaths
FROM ab GROUP BY 1, 2, 3""",
)
oracle(
    "completeness",
    AB,
    """SELECT data_source, 6 + CAST(week_ending_date IS NOT NULL AS INT) AS completeness, CAST(count(*) AS BIGINT) AS n
FROM ab GROUP BY 1, 2""",
)
oracle(
    "dedup_best",
    BEST,
    "SELECT year, week, mmwr_week, state, deaths, week_ending_date, data_source FROM best",
)
oracle(
    "merge_clean",
    BEST,
    """SELECT year, week, mmwr_week, 'S' || nk AS state, CAST(deaths AS DOUBLE) AS deaths, week_ending_date, data_source
FROM best WHERE nk < 20 AND NOT (nk = 3 AND week = 5) AND NOT (nk = 4 AND week = 6)""",
)
oracle(
    "row_lineage",
    AB + ", whole AS (SELECT * FROM ab WHERE mmwr_week <> 11 AND week <> 9)",
    """SELECT 0 AS step, 'union' AS stage, CAST(count(*) AS BIGINT) AS rows FROM ab
UNION ALL SELECT 1, 'complete', CAST(count(*) AS BIGINT) FROM whole
UNION ALL SELECT 2, 'dedup', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT year, week, state FROM whole)
UNION ALL SELECT 3, 'known_state', CAST(count(*) AS BIGINT)
  FROM (SELECT DISTINCT year, week, state FROM whole WHERE nk = 7)""",
)
oracle("population_dim", POP_ONLY, "SELECT year, state, population FROM pop")
oracle("population_nested", POP_ONLY, "SELECT year, state, population FROM pop")
oracle(
    "population_gap",
    FACT_POP,
    """SELECT year, CAST(sum(population) FILTER (WHERE state = 'United States') AS BIGINT) AS national,
       CAST(coalesce(sum(population) FILTER (WHERE state <> 'United States'), 0) AS BIGINT) AS parts,
       CAST(sum(population) FILTER (WHERE state = 'United States')
            - coalesce(sum(population) FILTER (WHERE state <> 'United States'), 0) AS BIGINT) AS gap
FROM fpop GROUP BY year""",
)
oracle(
    "join_population",
    f"{W}, {POP_ONLY}",
    """SELECT w.year, w.week, w.state, w.deaths, pop.population
FROM w LEFT JOIN pop ON pop.state = w.state AND pop.year = w.year""",
)
oracle(
    "population_asof",
    f"{W}, {POP_ONLY}, {asof('w', 'pop', 'wp')}",
    "SELECT year, week, state, deaths, population FROM wp",
)
oracle(
    "mortality_rate",
    FP,
    """SELECT year, week, state,
       round_even(deaths / CAST(population AS DOUBLE) * 100000 * 10, 0) / 10 AS mortality_rate_per_100k FROM fp""",
)
oracle(
    "population_coverage",
    FP,
    """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(population) AS BIGINT) AS rows_with_population,
       count(population) / CAST(count(*) AS DOUBLE) * 100 AS coverage_pct, 
       CAST(count(*) FILTER (WHERE week % 10 = 3) AS BIGINT) AS rows_missing_week
FROM fp""",
)
oracle(
    "seasonal_baseline",
    W,
    f"""SELECT state, mmwr_week, {six('avg(deaths)', 'avg_2015_2019')},
       {six('avg(deaths) FILTER (WHERE year = 2015)', 'baseline_2015')}
FROM w WHERE year BETWEEN 2015 AND 2019 GROUP BY state, mmwr_week""",
)
oracle(
    "expected_deaths",
    f"{W}, {baselines('w')}",
    f"""SELECT state, year, week, CAST(years_from_2015 AS INT) AS years_from_2015, {six('growth_factor', 'growth_factor')},
       {six('expected_deaths', 'expected_deaths')} FROM b""",
)
oracle(
    "baseline_deviation",
    f"{W}, {baselines('w')}",
    f"""SELECT state, year, week, deaths, {six('avg_2015_2019', 'avg_2015_2019')}, {six('baseline_2015', 'baseline_2015')},
       {six('deviation_from_avg', 'deviation_from_avg')}, {six('deviation_from_expected', 'deviation_from_expected')}
FROM b""",
)
oracle(
    "series_raw",
    W,
    """SELECT year, mmwr_week, CAST(sum(deaths) AS BIGINT) AS value, 'All States Combined' AS selection
FROM w GROUP BY year, mmwr_week""",
)
oracle(
    "series_per_100k",
    FP,
    f"""SELECT year, mmwr_week, {six('sum(deaths) / CAST(sum(population) AS DOUBLE) * 100000', 'value')},
       'All States Combined' AS selection
FROM fp GROUP BY year, mmwr_week""",
)
oracle(
    "series_per_100k_known",
    FP,
    f"""SELECT year, mmwr_week, {six('sum(deaths) / CAST(sum(population) AS DOUBLE) * 100000', 'value')},
       'All States Combined' AS selection
FROM fp WHERE population IS NOT NULL GROUP BY year, mmwr_week""",
)
oracle(
    "series_dev_avg",
    f"{FACTS}, {baselines('f')}",
    f"""SELECT year, mmwr_week, {six('coalesce(sum(deviation_from_avg), 0)', 'value')},
       CAST(count(*) FILTER (WHERE deviation_from_avg IS NULL) AS BIGINT) AS n_missing_baseline,
       'All States Combined' AS selection
FROM b GROUP BY year, mmwr_week""",
)
oracle(
    "series_dev_expected",
    f"{FACTS}, {baselines('f')}",
    f"""SELECT year, mmwr_week, {six('coalesce(sum(deviation_from_expected), 0)', 'value')},
       CAST(count(*) FILTER (WHERE deviation_from_expected IS NULL) AS BIGINT) AS n_missing_baseline,
       'Alabama, Alaska' AS selection
FROM b WHERE state IN ('Alabama', 'Alaska') GROUP BY year, mmwr_week""",
)
PERIOD = """CASE WHEN year BETWEEN 2015 AND 2019 THEN 'baseline' WHEN year BETWEEN 2020 AND 2022 THEN 'pandemic'
    WHEN year IN (2023, 2024) THEN 'recent' WHEN year = 2025 THEN 'current' ELSE 'other' END"""
COLOUR = """CASE WHEN year BETWEEN 2015 AND 2019 THEN '#2E8B57' WHEN year BETWEEN 2020 AND 2022 THEN '#DC143C'
    WHEN year IN (2023, 2024) THEN '#FF69B4' WHEN year = 2025 THEN '#1E90FF' ELSE '#808080' END"""
oracle(
    "series_endpoints",
    W + ", s AS (SELECT year, mmwr_week, CAST(sum(deaths) AS BIGINT) AS value FROM w GROUP BY year, mmwr_week)",
    f"""SELECT year, mmwr_week, value, {PERIOD} AS period, {COLOUR} AS colour
FROM s QUALIFY row_number() OVER (PARTITION BY year ORDER BY mmwr_week DESC) = 1""",
)
oracle(
    "year_band",
    W + ", y AS (SELECT year - 1 + nk % 7 AS year FROM w)",
    f"SELECT year, {PERIOD} AS period, {COLOUR} AS colour, CAST(count(*) AS BIGINT) AS n FROM y GROUP BY year",
)
oracle(
    "excess_vs_baseline",
    FACTS
    + """, base AS (SELECT week, avg(deaths) AS baseline FROM f
  WHERE state = 'United States' AND year IN (2017, 2018, 2019) GROUP BY week),
actual AS (SELECT week, CAST(deaths AS DOUBLE) AS actual FROM f WHERE state = 'United States' AND year = 2020)""",
    f"""SELECT coalesce(base.week, actual.week) AS week, {six('actual', 'actual')}, {six('baseline', 'baseline')},
       {six('actual - baseline', 'excess')}
FROM base FULL JOIN actual ON base.week = actual.week""",
)
oracle("metric_total", W, "SELECT CAST(sum(deaths) AS BIGINT) AS total_deaths FROM w")


def _rate(period: tuple[int, int], years: str) -> str:
    inside = f"FILTER (WHERE year BETWEEN {period[0]} AND {period[1]})"
    return (
        f"coalesce(round_even(sum(deaths) {inside} / CAST(sum(population) {inside} AS DOUBLE) * 100000"
        f" * count(*) {inside} / ({years} * 52.18::DOUBLE) * 10, 0) / 10, 0.0::DOUBLE)"
    )


RECENT_YEARS = "count(DISTINCT year) FILTER (WHERE year BETWEEN 2023 AND 2025)"
RATES = {
    "2015_2019": _rate((2015, 2019), "5"),
    "2020_2022": _rate((2020, 2022), "3"),
    "2023_2025": _rate((2023, 2025), RECENT_YEARS),
}


def _pooled(prefix: str) -> str:
    first, last = prefix.split("_")
    inside = f"FILTER (WHERE year BETWEEN {first} AND {last} AND population IS NOT NULL)"
    return f"coalesce(sum(deaths) {inside} / CAST(sum(population) {inside} AS DOUBLE) * 100000, 0)"


oracle(
    "metric_period_rates",
    FP + ", moved AS (SELECT * REPLACE (CASE WHEN year >= 2020 THEN year + 3 ELSE year END AS year) FROM fp)",
    "SELECT "
    + ",\n       ".join(
        f"{six(rate, f'rate_{p}')}, {six(_pooled(p), f'rate_pooled_weekly_{p}')}, "
        f"{six(f'{_pooled(p)} * 52.18::DOUBLE', f'rate_pooled_annual_{p}')}"
        for p, rate in RATES.items()
    )
    + "\nFROM moved",
)
ABOVE = ",\n       ".join(
    f"CAST(trunc(coalesce(sum(CAST({d} AS DECIMAL(28, 9))) FILTER (WHERE {d} > 0 AND year BETWEEN 2020 AND 2022), 0)) AS BIGINT) AS {n}"
    for d, n in (("deviation_from_avg", "total_above_avg"), ("deviation_from_expected", "total_above_expected"))
)
DASHBOARD = f"{FP}, {baselines('fp')}"
oracle("metric_excess", DASHBOARD, f"SELECT {ABOVE} FROM b")
oracle(
    "metric_selection",
    DASHBOARD,
    "SELECT CAST(sum(deaths) AS BIGINT) AS total_deaths, "
    + ", ".join(f"{rate} AS rate_{p}" for p, rate in RATES.items())
    + f",\n       {ABOVE} FROM b WHERE state IN ('Alabama', 'New York')",
)
oracle(
    "metric_by_name",
    DASHBOARD,
    f"""SELECT 'total_above_avg' AS metric, CAST(total_above_avg AS DOUBLE) AS value FROM (SELECT {ABOVE} FROM b)
UNION ALL SELECT 'no such metric', 0.0::DOUBLE""",
)
oracle(
    "validate_yoy",
    FACTS
    + ", "
    + state_years("f")
    + """,
checks AS (
  SELECT 'entity' AS scope, state AS name, total_before, total_after, CAST(1 AS BIGINT) AS states_before,
         CAST(1 AS BIGINT) AS states_after, 10 AS lim
  FROM t18 JOIN t19 USING (state) WHERE state = 'New York'
  UNION ALL
  SELECT 'overall', 'all states', CAST((SELECT sum(total_before) FROM t18) AS BIGINT),
         CAST((SELECT sum(total_after) FROM t19) AS BIGINT), CAST((SELECT count(*) FROM t18) AS BIGINT),
         CAST((SELECT count(*) FROM t19) AS BIGINT), 5)""",
    f"""SELECT scope, name, total_before, total_after, states_before, states_after, {six(CHANGE, 'change_pct')},
       CASE WHEN abs({CHANGE}) > lim THEN 'warning' ELSE 'reasonable' END AS status,
       name || ': ' || format('{{:,}}', total_before) || ' -> ' || format('{{:,}}', total_after)
         || ' (' || printf('%+.1f', {CHANGE}) || '%)' AS report FROM checks""",
)
oracle(
    "state_yoy",
    f"{UNEVEN}, {state_years('u')}",
    f"""SELECT coalesce(t18.state, t19.state) AS state, total_before, total_after, {six(CHANGE, 'change_pct')}
FROM t18 FULL JOIN t19 ON t18.state = t19.state""",
)
oracle(
    "entity_yoy",
    f"{FACTS}, {state_years('f')}",
    f"""SELECT state, total_before, total_after, {six(CHANGE, 'change_pct')}
FROM t18 JOIN t19 USING (state) WHERE state = 'New York'""",
)
oracle(
    "coverage_diff",
    f"{UNEVEN}, {state_years('u')}",
    """SELECT state, 'missing in 2019' AS side FROM t18 WHERE state NOT IN (SELECT state FROM t19)
UNION ALL SELECT state, 'new in 2019' FROM t19 WHERE state NOT IN (SELECT state FROM t18)""",
)
oracle(
    "top5_yoy",
    FACTS
    + """, u AS (SELECT * REPLACE (CASE WHEN nk = 6 THEN deaths * 100 ELSE deaths END AS deaths) FROM f
  WHERE NOT (nk = 6 AND year = 2018)), """
    + f"{state_years('u')}, top AS (SELECT * FROM t19 ORDER BY total_after DESC, state LIMIT 5)",
    f"""SELECT top.state, total_before, total_after, {six(CHANGE, 'change_pct')},
       CASE WHEN total_before IS NULL THEN 'new in 2019' ELSE printf('%+.1f', {CHANGE}) || '% vs 2018' END AS note
FROM top LEFT JOIN t18 ON t18.state = top.state""",
)
oracle(
    "top10_states",
    FACTS,
    """SELECT state, CAST(sum(deaths) AS BIGINT) AS deaths FROM f WHERE year = 2019 AND state <> 'United States'
GROUP BY state ORDER BY deaths DESC, state LIMIT 10""",
)
oracle("yearly_totals", W, "SELECT year, CAST(sum(deaths) AS BIGINT) AS deaths FROM w GROUP BY year")
YEARLY = """SELECT year, CAST(sum(deaths) AS BIGINT) AS deaths, CAST(arg_min(population + week * 7, week) AS BIGINT) AS population
  FROM fp WHERE state = 'United States' GROUP BY year"""
oracle(
    "yearly_rate",
    f"{FP}, yr AS ({YEARLY})",
    f"""SELECT year, deaths, population, {six('deaths / CAST(population AS DOUBLE) * 100000', 'rate_per_100k')} FROM yr""",
)
oracle(
    "report_text",
    f"{FP}, yr AS ({YEARLY})",
    """SELECT year, year || ': ' || format('{:,}', deaths) || ' deaths' || coalesce(' | Pop: ' || format('{:,}', population)
       || ' | Rate: ' || format('{:.1f}', round_even(deaths / CAST(population AS DOUBLE) * 100000 * 10, 0) / 10)
       || ' per 100k', '') AS report FROM yr""",
)
STATE_WEEKS = "sw AS (SELECT state, count(DISTINCT week) AS weeks FROM {0} WHERE year = 2019 GROUP BY state)"
COVER = f"""CAST(count(*) AS BIGINT) AS states_with_data,
       CAST(count(*) FILTER (WHERE weeks >= 52) AS BIGINT) AS states_with_full_year,
       {six('avg(weeks)', 'average_weeks_per_state')}"""
oracle("coverage_2019", f"{W}, {STATE_WEEKS.format('w')}", f"SELECT {COVER} FROM sw")
oracle(
    "weeks_per_state",
    W,
    "SELECT state, CAST(count(DISTINCT week) AS BIGINT) AS weeks FROM w WHERE year = 2019 GROUP BY state",
)
oracle(
    "weeks_per_year",
    AB,
    "SELECT data_source, year, CAST(count(DISTINCT week) AS BIGINT) AS weeks FROM ab GROUP BY data_source, year",
)
oracle(
    "dataset_info",
    W,
    "SELECT CAST(count(*) AS BIGINT) AS records, min(year) AS first_year, max(year) AS last_year FROM w",
)
oracle(
    "distinct_lists",
    AB,
    """SELECT DISTINCT 'year' AS name, CAST(year AS VARCHAR) AS value FROM ab
UNION ALL SELECT DISTINCT 'state', state FROM ab
UNION ALL SELECT DISTINCT 'data_source', data_source FROM ab""",
)
oracle(
    "presence_check",
    FACTS + ", us AS (SELECT * FROM f WHERE state = 'United States')",
    """SELECT CAST(count(*) FILTER (WHERE year = 2020 AND week = 1) AS BIGINT) AS rows_in_week,
       CAST(sum(deaths) FILTER (WHERE year = 2020 AND week = 1) AS BIGINT) AS deaths_in_week,
       (SELECT string_agg(CAST(week AS VARCHAR), ',' ORDER BY week)
        FROM (SELECT DISTINCT week FROM us WHERE year = 2020)) AS weeks_in_year,
       CAST(coalesce(sum(deaths) FILTER (WHERE year = 2019), 0) AS BIGINT) AS total_in_year
FROM us""",
)
oracle(
    "entity_first_weeks",
    FACTS,
    """SELECT week, CAST(sum(deaths) AS BIGINT) AS deaths FROM f
WHERE state = 'New York' AND year = 2019 AND week BETWEEN 1 AND 5 GROUP BY week""",
)
oracle("entity_total", FOLD, "SELECT CAST(sum(deaths) AS BIGINT) AS deaths FROM fo WHERE nk IN (1, 2, 3)")
oracle(
    "summary_stats",
    f"{BEST}, {STATE_WEEKS.format('best')}, "
    "ty AS (SELECT year, CAST(sum(deaths) AS BIGINT) AS d FROM best GROUP BY year), "
    f"cover AS (SELECT {COVER} FROM sw), "
    "src AS (SELECT data_source, min((year, week, state)) AS seen FROM best GROUP BY data_source)",
    """SELECT 'state' AS data_type, CAST(count(*) AS BIGINT) AS total_records, min(year) || '-' || max(year) AS years_covered,
       CAST(sum(deaths) AS BIGINT) AS total_deaths,
       (SELECT string_agg(data_source, ',' ORDER BY seen) FROM src) AS data_sources,
       CAST(count(DISTINCT state) AS BIGINT) AS states_count,
       (SELECT string_agg(state, ',' ORDER BY state) FROM (SELECT DISTINCT state FROM best)) AS state_coverage,
       (SELECT states_with_data FROM cover) AS states_with_data,
       (SELECT states_with_full_year FROM cover) AS states_with_full_year,
       (SELECT average_weeks_per_state FROM cover) AS average_weeks_per_state,
       (SELECT string_agg(year || '=' || d, ',' ORDER BY year) FROM ty) AS yearly_totals
FROM best""",
)

oracle(
    "summary_national",
    FACTS + ", us AS (SELECT * FROM f WHERE state = 'United States'), "
    "ty AS (SELECT year, CAST(sum(deaths) AS BIGINT) AS d FROM us GROUP BY year)",
    """SELECT 'national' AS data_type, CAST(count(*) AS BIGINT) AS total_records, min(year) || '-' || max(year) AS years_covered,
       CAST(sum(deaths) AS BIGINT) AS total_deaths, 'orders' AS data_sources,
       (SELECT string_agg(year || '=' || d, ',' ORDER BY year) FROM ty) AS yearly_totals
FROM us""",
)


def _dated(parity: bool) -> str:
    rule = sunday_week if parity else mmwr_week
    date = "date" if parity else f"coalesce(strftime({parsed('date')}, '%Y-%m-%d'), date)"
    year = "2019" if parity else mmwr_year("day")
    return f"""{EVENTS}, {BACK}, p AS (
  SELECT label AS state, {number('number')} AS deaths, {parsed('date')} AS day, {date} AS week_ending_date
  FROM back WHERE event_id % 7 <> 5),
k AS (
  SELECT CAST({year} AS DOUBLE) AS year,
         CAST({'greatest(' + rule('day') + ' - 1, 1)' if parity else rule('day')} AS DOUBLE) AS week,
         week_ending_date, state, deaths
  FROM p WHERE deaths > 0
  AND (state IS NULL OR state NOT IN ('United States', 'US', 'USA', 'National', 'Total'))),
s AS (SELECT year, week, week AS mmwr_week, week_ending_date, state, deaths, 'Local 2019 File' AS data_source FROM k),
{folded('s', 'o')}"""


oracle("ingest_dated_file", _dated(False), "SELECT * FROM o")
oracle("ingest_dated_file_parity", _dated(True), "SELECT * FROM o")


def _country(parity: bool) -> str:
    unit = "" if parity else "AND event_id % 5 <> 0 AND week BETWEEN 1 AND 53"
    return f"""SELECT CAST(year AS DOUBLE) AS year, CAST(week AS DOUBLE) AS week, CAST(week AS DOUBLE) AS mmwr_week,
       'United States' AS state, CASE WHEN event_id % 7 = 5 THEN NULL ELSE {number('number')} END AS deaths,
       'World Mortality Dataset' AS data_source
FROM ev WHERE event_id % 3 <> 0 AND event_id % 11 <> 0 AND year BETWEEN 2015 AND 2020 {unit}"""


oracle("ingest_country_series", EVENTS, _country(False))
oracle("ingest_country_series_parity", EVENTS, _country(True))


def _provisional(parity: bool) -> str:
    date = "date" if parity else f"coalesce(strftime({parsed('date')}, '%Y-%m-%d'), date)"
    return f"""{EVENTS}, s AS (
  SELECT CAST(year AS DOUBLE) AS year, CAST(week AS DOUBLE) AS week, CAST(week AS DOUBLE) AS mmwr_week,
         {date} AS week_ending_date, label AS state, {number('number')} AS deaths, 'CDC Provisional' AS data_source
  FROM ev WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 7 <> 5 AND year >= 2020
  AND {number('number')} > 0 AND week BETWEEN 1 AND 53),
{folded('s', 'o')}"""


oracle("ingest_provisional", _provisional(False), "SELECT * FROM o")
oracle("ingest_provisional_parity", _provisional(True), "SELECT * FROM o")
oracle(
    "ingest_packed_week",
    f"""{EVENTS}, s AS (
  SELECT CAST(year AS DOUBLE) AS year, CAST(week AS DOUBLE) AS week, CAST(week AS DOUBLE) AS mmwr_week,
         CAST(NULL AS VARCHAR) AS week_ending_date, label AS state, {number('number')} AS deaths,
         'Archived NCHS' AS data_source
  FROM ev WHERE event_id % 9 <> 0 AND event_id % 11 <> 0 AND event_id % 7 <> 5 AND year BETWEEN 2015 AND 2018
  AND {number('number')} > 0 AND week BETWEEN 1 AND 53),
{folded('s', 'o')}""",
    "SELECT * EXCLUDE (week_ending_date) FROM o",
)
oracle("scan_csv", W, "SELECT year, week, state, week_ending_date, deaths FROM w")

OUTPUT = """SELECT year, week, mmwr_week, week_ending_date, state, CAST(deaths AS DOUBLE) AS deaths, population,
       round_even(deaths / CAST(population AS DOUBLE) * 100000 * 10, 0) / 10 AS mortality_rate_per_100k, {0} AS data_source
FROM {1}"""
for _name, _where in (
    ("compile_national", "state = 'United States'"),
    ("compile_states", "state <> 'United States'"),
    ("sink_national", "state = 'United States'"),
    ("sink_states", "state <> 'United States'"),
):
    oracle(_name, FP, OUTPUT.format("'orders'", "fp") + f" WHERE {_where}")


ALL_SOURCES = ("dated", "country", "packed", "prov")


def _compile(parity: bool, names: tuple[str, ...] = ALL_SOURCES, packed_deaths: str = "deaths", packed_from: int = 2015) -> str:
    """The whole batch on the raw layouts named, in typed form."""
    rule = f"greatest({sunday_week('moved')} - 1, 1)" if parity else mmwr_week("moved")
    us_date = "strftime(CAST(week_ending_date AS DATE), '%-m/%-d/%Y')"
    iso_moved, us_moved = (f"strftime(moved, '{p}')" for p in ("%Y-%m-%d", "%-m/%-d/%Y"))
    dated_text = f"CASE WHEN nk % 2 = 0 THEN {iso_moved} ELSE {us_moved} END" if parity else iso_moved
    dated_year = "2019" if parity else mmwr_year("moved")
    provisional_text = us_date if parity else "week_ending_date"
    unit = "" if parity else "AND week <> 53"

    def fold_source(name: str) -> str:
        return f"""SELECT {_source_order[name]} AS source_ord, year, week, week_ending_date,
  CASE WHEN {IS_CITY} THEN 'New York' ELSE state END AS state, data_source, sum(deaths) AS deaths
  FROM {name} GROUP BY ALL"""

    _source_order = {"dated": 0, "packed": 2, "prov": 3}
    parts = {name: fold_source(name) for name in _source_order} | {
        "country": f"""SELECT 1, year, week, CAST(NULL AS VARCHAR), 'United States', 'World Mortality Dataset', deaths * 10
  FROM r WHERE nk = 0 AND year BETWEEN 2015 AND 2020 {unit}"""
    }
    return f"""{W},
r AS (SELECT nk, {_list(SOURCE_NAMES)}[nk + 1] AS state, year, week, week_ending_date, deaths,
             CAST(week_ending_date AS DATE) + 7301 AS moved FROM w),
dated AS (SELECT {dated_year} AS year, {rule} AS week, {dated_text} AS week_ending_date, state, deaths,
                 'Local 2019 File' AS data_source
  FROM r WHERE year = 2019 AND state <> 'United States' AND NOT (nk = 7 AND week % 10 = 0)),
packed AS (SELECT year, week, CAST(NULL AS VARCHAR) AS week_ending_date, state, {packed_deaths} AS deaths,
                  'Archived NCHS' AS data_source
  FROM r WHERE year BETWEEN {packed_from} AND 2018 AND nk % 9 <> 8 AND NOT (nk = 10 AND week = 7)),
prov AS (SELECT year, week, {provisional_text} AS week_ending_date, state, deaths + 1 AS deaths,
                'CDC Provisional' AS data_source
  FROM r WHERE year >= 2020 AND NOT (nk = 11 AND week = 9) AND NOT (nk = 12 AND week = 3) AND NOT (nk = 13 AND week = 2)),
merged AS (
  {" UNION ALL ".join(parts[name] for name in names)}),
deduped AS (
  SELECT CAST(year AS INT) AS year, CAST(week AS INT) AS week, CAST(week AS INT) AS mmwr_week, week_ending_date, state,
         deaths, data_source
  FROM merged QUALIFY row_number() OVER (
    PARTITION BY year, week, state
    ORDER BY CASE WHEN week_ending_date IS NULL THEN 1 ELSE 0 END, source_ord, week_ending_date) = 1),
{FACT_POP}, {asof('deduped', 'fpop', 'out')}"""


oracle("flagship_compile", _compile(False), OUTPUT.format("data_source", "out"))
oracle("flagship_compile_parity", _compile(True), OUTPUT.format("data_source", "out"))
oracle(
    "flagship_landing",
    _compile(False, ("dated", "prov")),
    OUTPUT.format("data_source", "out") + " WHERE state <> 'United States'",
)
oracle(
    "flagship_landing_counts",
    _compile(False, ("dated", "prov")),
    """SELECT 0 AS step, 'dated_file read' AS stage, CAST(count(*) AS BIGINT) AS rows FROM r WHERE year = 2019
UNION ALL SELECT 1, 'dated_file normalised', CAST(count(*) AS BIGINT) FROM merged WHERE source_ord = 0
UNION ALL SELECT 2, 'country_series read', 0
UNION ALL SELECT 3, 'country_series normalised', 0
UNION ALL SELECT 4, 'packed_week read', 0
UNION ALL SELECT 5, 'packed_week normalised', 0
UNION ALL SELECT 6, 'provisional read', CAST(count(*) AS BIGINT) FROM r WHERE year >= 2019
UNION ALL SELECT 7, 'provisional normalised', CAST(count(*) AS BIGINT) FROM merged WHERE source_ord = 3
UNION ALL SELECT 8, 'cleaned', CAST(count(*) AS BIGINT) FROM deduped""",
)
oracle(
    "recompile_revised",
    _compile(False, packed_deaths="CASE WHEN year = 2016 THEN deaths * 2 ELSE deaths END", packed_from=2016),
    OUTPUT.format("data_source", "out"),
)
oracle(
    "sink_empty_extract",
    FP,
    """SELECT 'national' AS extract, CAST(0 AS BIGINT) AS rows
UNION ALL SELECT 'states', CAST(count(*) AS BIGINT) FROM fp WHERE state <> 'United States'""",
)
_LABELS = {"dated": "Local 2019 File", "country": "World Mortality Dataset", "packed": "Archived NCHS", "prov": "CDC Provisional"}
_ORDER = {"dated": 0, "country": 1, "packed": 2, "prov": 3}
_LANDED = {"dated": "dated_file", "country": "country_series", "packed": "packed_week", "prov": "provisional"}
# (source, reason, which raw rows) of the rows that leave before the fold
_LOST = [
    ("dated", "national total", "year = 2019 AND nk = 0"),
    ("dated", "no count", "year = 2019 AND nk = 7 AND week % 10 = 0"),
    ("country", "other country", "nk = 3"),
    ("country", "not weekly", "nk = 0 AND week = 53"),
    ("country", "outside the years", "nk = 0 AND week <> 53 AND year NOT BETWEEN 2015 AND 2020"),
    ("packed", "other age group", "year <= 2019 AND nk % 9 = 8"),
    ("packed", "outside the years", "year <= 2019 AND nk % 9 <> 8 AND (nk = 10 AND week = 7 OR year NOT BETWEEN 2015 AND 2018)"),
    ("prov", "outside the years", "year >= 2019 AND (nk = 11 AND week = 9 OR year = 2019)"),
    ("prov", "count not positive", "year >= 2020 AND nk = 13 AND week = 2"),
    ("prov", "no valid week", "year >= 2020 AND nk = 12 AND week = 3"),
]
_REJECTS = [
    f"SELECT '{_LANDED[name]}' AS source, 'normalise' AS stage, '{reason}' AS reason, count(*) AS rows FROM r WHERE {which}"
    for name, reason, which in _LOST
]
for _name in ALL_SOURCES:
    _read = f"SELECT count(*) FROM {_name}" if _name != "country" else "SELECT count(*) FROM merged WHERE source_ord = 1"
    _merged = f"SELECT count(*) FROM merged WHERE source_ord = {_ORDER[_name]}"
    _left = f"SELECT count(*) FROM deduped WHERE data_source = '{_LABELS[_name]}'"
    _REJECTS += [
        f"SELECT '{_LANDED[_name]}', 'fold', 'summed into another row', ({_read}) - ({_merged})",
        f"SELECT '{_LANDED[_name]}', 'clean', 'less complete duplicate', ({_merged}) - ({_left})",
    ]
oracle(
    "rejected_rows",
    _compile(False),
    "SELECT source, stage, reason, CAST(rows AS BIGINT) AS rows FROM (" + " UNION ALL ".join(_REJECTS) + ") WHERE rows > 0",
)
oracle(
    "malformed_lines",
    EVENTS
    + """, cells AS (SELECT event_id % 5 AS kind, year || ',' || week AS start, strftime(ts, '%Y-%m-%d') AS date,
  coalesce(label, '') AS state FROM ev),
lines AS (SELECT CASE kind WHEN 1 THEN start || ',' || date || ',' || state WHEN 2 THEN start || ',' || date || ',' || state || ',7,extra'
  ELSE start || ',"' || date || ',' || state || ',7' END AS line FROM cells WHERE kind IN (1, 2, 3))""",
    "SELECT 'provisional' AS source, line, CAST(count(*) AS BIGINT) AS rows FROM lines GROUP BY line",
)
oracle(
    "source_conflicts",
    _compile(False),
    """SELECT w.data_source AS kept_source, m.data_source AS source, CAST(count(*) AS BIGINT) AS keys,
       CAST(count(*) FILTER (WHERE m.deaths = w.deaths) AS BIGINT) AS agreeing,
       CAST(sum(abs(m.deaths - w.deaths)) AS DOUBLE) AS difference
FROM merged m JOIN deduped w ON m.year = w.year AND m.week = w.week AND m.state = w.state AND m.data_source <> w.data_source
GROUP BY ALL""",
)
oracle(
    "flagship_deviation",
    f"{BEST}, {baselines('best')}, {POP_ONLY}, {asof('b', 'pop', 'bp')}",
    f"""SELECT year, mmwr_week, {six('coalesce(sum(deviation_from_avg), 0)', 'value')},
       CAST(count(*) FILTER (WHERE deviation_from_avg IS NULL) AS BIGINT) AS n_missing_baseline,
       'All States Combined' AS selection
FROM bp WHERE round_even(deaths / CAST(population AS DOUBLE) * 100000 * 10, 0) / 10 > 0
GROUP BY year, mmwr_week""",
)
oracle(
    "population_runs",
    POP_ONLY
    + """, held AS (SELECT state, year, CASE WHEN nk % 4 = 0 THEN population // 1000 * 1000 + 1
    WHEN nk % 4 = 1 AND year >= 2018 THEN population // 500 * 500 ELSE population END AS population FROM pop),
islands AS (SELECT *, year - row_number() OVER (PARTITION BY state, population ORDER BY year) AS island FROM held),
runs AS (SELECT state, min(year) AS first_year, max(year) AS last_year, CAST(count(*) AS BIGINT) AS years, population
  FROM islands GROUP BY state, population, island)""",
    """SELECT *, CAST(years > 1 AS INT) AS repeated, CAST(population % 1000 = 0 AS INT) AS rounded FROM runs
WHERE years > 1 OR population % 1000 = 0""",
)
