"""One query per operator or pipeline: name -> callable(spark, sf_dir).

Sums of doubles are published to six decimals, because their last bits depend
on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.functions.calendar import epi_week, parse_date, shift_weeks, split_year_week, unparsed_dates, week_ending
from tallyweek.functions.columns import compute_once, discover_columns
from tallyweek.functions.numbers import round_half_even, to_number
from tallyweek.operators import baseline, combine, filters, fold, metrics, quality, reject, series
from tallyweek.operators import population as pop
from tallyweek.plans.compile import SOURCES, compile_facts, compile_landing, finish_facts, rejected_rows
from tallyweek.rules import DEFAULT, PARITY, Rules
from tallyweek.schema import CITY, CITY_PARENT, NATIONAL
from tallyweek.sources import ingest
from tallyweek.sources.scan import flatten_population, scan_compiled, scan_csv, scan_population
from tallyweek.sources.sinks import write_csv, write_outputs
from tallyweek.workloads import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    # a trailing underscore only keeps the function apart from an imported name
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def six(name: str, column: str | None = None) -> Column:
    return round_half_even(F.col(column or name).cast("double"), 6).alias(name)


# --- calendar and text -------------------------------------------------------


@query
def epi_week_(spark, sf_dir):
    days = views.order_days(spark, sf_dir).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    sunday, mmwr = epi_week(F.col("day"), "first_sunday"), epi_week(F.col("day"), "mmwr")
    return days.select(
        "day",
        "n",
        week_ending(F.col("day")).alias("saturday"),
        sunday[0].alias("sunday_year"),
        sunday[1].alias("sunday_week"),
        mmwr[0].alias("mmwr_year"),
        mmwr[1].alias("mmwr_week"),
    )


@query
def shift_weeks_(spark, sf_dir):
    shifted = views.weekly(spark, sf_dir).withColumn("shifted", shift_weeks(F.col("week")))
    return shifted.groupBy("year", "week", "shifted").agg(F.sum("deaths").alias("deaths"))


@query
def week_range(spark, sf_dir):
    shifted = views.weekly(spark, sf_dir).withColumn("week", shift_weeks(F.col("week")))
    return quality.week_range(shifted)


@query
def parse_dates(spark, sf_dir):
    events = views.dirty_events(spark, sf_dir).withColumn("date", views.any_date_text(F.col("event_id"), F.col("day")))
    parsed = compute_once(events.select("event_id", "date"), {"parsed": parse_date(F.col("date"))})
    year, week = epi_week(F.col("parsed"), "first_sunday")
    return parsed.select("event_id", "date", "parsed", year.alias("year"), week.alias("week"))


@query
def unparsed_dates_(spark, sf_dir):
    events = views.dirty_events(spark, sf_dir)
    return unparsed_dates(events.select(views.any_date_text(F.col("event_id"), F.col("day")).alias("week_ending_date")))


@query
def coerce_numeric(spark, sf_dir):
    events = views.dirty_events(spark, sf_dir)
    return events.select(
        "event_id",
        to_number(F.col("number")).alias("strict"),
        to_number(F.col("number"), thousands=",").alias("lenient"),
    )


@query
def split_year_week_(spark, sf_dir):
    raw = views.raw_packed_week(spark, sf_dir).select("`MMWR Year/Week`")
    packed = compute_once(raw, {"packed": to_number(F.col("`MMWR Year/Week`"))})
    year, week = split_year_week(F.col("packed"))
    parts = packed.select(year.alias("year"), week.alias("week"))
    return parts.groupBy("year", "week").agg(F.count(F.lit(1)).alias("n"))


@query
def discover_columns_(spark, sf_dir):
    found = discover_columns(views.raw_dated_file(spark, sf_dir))
    return found.groupBy("week_ending_date", "state", "deaths").agg(F.count(F.lit(1)).alias("n"))


# --- filters and selections --------------------------------------------------


@query
def valid_measure(spark, sf_dir):
    events = views.dirty_events(spark, sf_dir)
    typed = compute_once(events.select("event_id", "number"), {"deaths": to_number(F.col("number"))})
    return filters.valid_measure(typed).select("event_id", "deaths")


@query
def valid_week(spark, sf_dir):
    raw = views.raw_provisional(spark, sf_dir).select("`MMWR Week`")
    typed = compute_once(raw, {"week": to_number(F.col("`MMWR Week`"))})
    return filters.valid_week(typed).groupBy("week").agg(F.count(F.lit(1)).alias("n"))


@query
def exclude_totals(spark, sf_dir):
    rows = views.dirty_events(spark, sf_dir).select(F.col("label").alias("state"))
    return filters.exclude_totals(rows).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query
def valid_jurisdictions(spark, sf_dir):
    rows = views.dirty_events(spark, sf_dir).select(F.col("label").alias("state"))
    return filters.valid_jurisdictions(rows).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query
def filter_country(spark, sf_dir):
    rows = filters.of_country(views.raw_country_series(spark, sf_dir))
    return rows.groupBy("country_name", "time_unit").agg(F.count(F.lit(1)).alias("n"))


@query
def split_national_state(spark, sf_dir):
    rows = views.foldable(spark, sf_dir)
    return rows.groupBy(filters.side().alias("side")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("deaths").alias("deaths")
    )


def _picked(spark, sf_dir, states):
    rows = filters.select_states(views.facts(spark, sf_dir), states)
    label = F.lit(filters.selection_label(states)).alias("selection")
    return rows.groupBy("year").agg(F.sum("deaths").alias("deaths")).select(label, "year", "deaths")


@query
def select_states(spark, sf_dir):
    return _picked(spark, sf_dir, ["All States", "Ohio", "Alabama"])


@query
def select_all_states(spark, sf_dir):
    return _picked(spark, sf_dir, ["All States"])


@query
def state_choices(spark, sf_dir):
    return filters.state_choices(views.weekly(spark, sf_dir))


# --- folding and roll-up -----------------------------------------------------


@query
def fold_entities(spark, sf_dir):
    return fold.fold_entities(views.foldable(spark, sf_dir).drop("nk"))


def _labelled_events(spark, sf_dir):
    return views.dirty_events(spark, sf_dir).select(
        "year", "week", F.col("label").alias("state"), to_number(F.col("number")).alias("deaths")
    )


def _fold_events(spark, sf_dir, without):
    rows = _labelled_events(spark, sf_dir)
    rows = rows.filter(~F.coalesce(without, F.lit(False)))
    folded = fold.fold_entities(rows, how=PARITY.fold)
    return folded.groupBy("year", "state").agg(F.count(F.lit(1)).alias("n"), F.sum("deaths").alias("deaths"))


@query
def fold_city_only(spark, sf_dir):
    return _fold_events(spark, sf_dir, F.col("state") == CITY_PARENT)


@query
def fold_state_only(spark, sf_dir):
    return _fold_events(spark, sf_dir, F.col("state").contains(CITY) | F.col("state").contains("NYC"))


@query
def fold_both(spark, sf_dir):
    return _fold_events(spark, sf_dir, F.lit(False))


@query
def fold_stray_city(spark, sf_dir):
    """One row of the city among rows that are never summed with it."""
    rows = _labelled_events(spark, sf_dir).filter(F.col("state").isin("Ohio", CITY_PARENT))
    stray = spark.range(1).select(
        F.lit(2020).alias("year"), F.lit(60).alias("week"), F.lit("Bronx NYC").alias("state"), F.lit(5.0).alias("deaths")
    )
    folded = fold.fold_entities(rows.unionByName(stray), how=DEFAULT.fold)
    return folded.filter(F.col("state") == "Ohio").select("year", "week", "state", "deaths")


@query
def first_per_entity(spark, sf_dir):
    rows = views.foldable(spark, sf_dir)
    late = rows.withColumn("week_ending_date", F.when(F.col("week") > 10, F.col("week_ending_date")))
    return fold.first_per_entity(late, ["week_ending_date"], ["year", "week", "nk"])


@query
def attach_first(spark, sf_dir):
    rows = views.foldable(spark, sf_dir)
    late = rows.withColumn("first_date", F.when(F.col("week") > 10, F.col("week_ending_date")))
    yearly = rows.groupBy("state", "year").agg(F.sum("deaths").alias("deaths"))
    return fold.attach_first(yearly, late, ["first_date"], ["year", "week", "nk"])


@query
def national_rollup(spark, sf_dir):
    rows = views.weekly(spark, sf_dir)
    undated = F.col("nk") % 2 == 0
    return fold.national_rollup(
        rows.withColumn("week_ending_date", F.when(~undated, F.col("week_ending_date")))
    )


# --- union, dedup, clean -----------------------------------------------------


@query
def union_sources(spark, sf_dir):
    dated, undated = views.two_sources(spark, sf_dir)
    merged = combine.union_sources([dated, None, undated])
    return merged.groupBy("source_ord", "data_source", "year").agg(
        F.count(F.lit(1)).alias("n"), F.count("week_ending_date").alias("dated"), F.sum("deaths").alias("deaths")
    )


@query
def completeness(spark, sf_dir):
    merged = combine.with_completeness(combine.union_sources(views.two_sources(spark, sf_dir)))
    return merged.groupBy("data_source", "completeness").agg(F.count(F.lit(1)).alias("n"))


@query
def dedup_best(spark, sf_dir):
    merged = combine.union_sources(views.two_sources(spark, sf_dir))
    return combine.dedup_best(merged).drop("source_ord")


def _named_sources(spark, sf_dir):
    return [
        rows.withColumn("state", F.concat(F.lit("S"), F.regexp_extract("state", r"(\d+)$", 1)))
        for rows in views.two_sources(spark, sf_dir)
    ]


@query
def merge_clean(spark, sf_dir):
    """Weeks of two nations are infinite or too large for an integer now and then."""
    known = [f"S{n}" for n in range(20)]
    week = (
        F.when((F.col("state") == "S3") & (F.col("week") == 5), F.lit(float("inf")))
        .when((F.col("state") == "S4") & (F.col("week") == 6), F.lit(1e12))
        .otherwise(F.col("week").cast("double"))
    )
    return combine.merge_clean([rows.withColumn("week", week) for rows in _named_sources(spark, sf_dir)], jurisdictions=known)


@query
def row_lineage(spark, sf_dir):
    names = [
        rows.withColumns(
            {
                "state": F.when(F.col("state") == "NATION_7", F.lit("Ohio")).otherwise(F.col("state")),
                "deaths": F.when(F.col("week") != 9, F.col("deaths")),
                "week": F.when(F.col("mmwr_week") != 11, F.col("week")),
            }
        )
        for rows in views.two_sources(spark, sf_dir)
    ]
    return combine.row_lineage(combine.union_sources(names))


# --- population --------------------------------------------------------------


@query
def population_dim(spark, sf_dir):
    path = views.scratch(spark, "population")
    views.population(spark, sf_dir).select("year", "state", "population").write.mode("overwrite").option("header", True).csv(path)
    return scan_population(spark, path)


@query
def population_nested(spark, sf_dir):
    rows = views.population(spark, sf_dir)
    nested = rows.groupBy("year").agg(
        F.map_from_entries(F.collect_list(F.struct("state", "population"))).alias("populations")
    )
    return flatten_population(nested)


@query
def population_gap(spark, sf_dir):
    return pop.population_gap(views.facts_population(spark, sf_dir))


@query
def population_runs(spark, sf_dir):
    """Every fourth nation has one value for all years, every fourth but one a rounded one from 2018 on."""
    rows, value = views.population(spark, sf_dir), F.col("population")
    value = F.when(F.col("nk") % 4 == 0, F.floor(value / 1000) * 1000 + 1).otherwise(value)
    value = F.when((F.col("nk") % 4 == 1) & (F.col("year") >= 2018), F.floor(value / 500) * 500).otherwise(value)
    runs = pop.population_runs(rows.withColumn("population", value.cast("bigint")))
    return runs.withColumns({"repeated": F.col("repeated").cast("int"), "rounded": F.col("rounded").cast("int")})


@query
def join_population(spark, sf_dir):
    rows = pop.attach_population(views.weekly(spark, sf_dir), views.population(spark, sf_dir), tolerance=0)
    return rows.select("year", "week", "state", "deaths", "population")


@query
def population_asof(spark, sf_dir):
    rows = pop.attach_population(views.weekly(spark, sf_dir), views.population(spark, sf_dir))
    return rows.select("year", "week", "state", "deaths", "population")


def _facts_with_population(spark, sf_dir):
    return pop.attach_population(views.facts(spark, sf_dir), views.facts_population(spark, sf_dir))


@query
def mortality_rate(spark, sf_dir):
    rows = pop.with_rate(_facts_with_population(spark, sf_dir))
    return rows.select("year", "week", "state", "mortality_rate_per_100k")


@query
def population_coverage(spark, sf_dir):
    rows = _facts_with_population(spark, sf_dir)
    return pop.population_coverage(rows.withColumn("week", F.when(F.col("week") % 10 != 3, F.col("week"))))


# --- baselines and series ----------------------------------------------------


@query
def seasonal_baseline(spark, sf_dir):
    means = baseline.seasonal_baseline(views.weekly(spark, sf_dir))
    return means.select("state", "mmwr_week", six("avg_2015_2019"), six("baseline_2015"))


@query
def expected_deaths(spark, sf_dir):
    rows = baseline.with_baselines(views.weekly(spark, sf_dir), one_row_per_week=True)
    return rows.select("state", "year", "week", "years_from_2015", six("growth_factor"), six("expected_deaths"))


@query
def baseline_deviation(spark, sf_dir):
    rows = baseline.with_baselines(views.weekly(spark, sf_dir))
    return rows.select(
        "state",
        "year",
        "week",
        "deaths",
        six("avg_2015_2019"),
        six("baseline_2015"),
        six("deviation_from_avg"),
        six("deviation_from_expected"),
    )


@query
def series_raw(spark, sf_dir):
    return series.series(views.weekly(spark, sf_dir), "raw")


@query
def series_per_100k(spark, sf_dir):
    points = series.series(_facts_with_population(spark, sf_dir), "deaths_per_100k")
    return points.select("year", "mmwr_week", six("value"), "selection")


@query
def series_per_100k_known(spark, sf_dir):
    points = series.series(_facts_with_population(spark, sf_dir), "deaths_per_100k", require_population=True)
    return points.select("year", "mmwr_week", six("value"), "selection")


def _deviation_series(spark, sf_dir, kind, states=("All States",)):
    points = series.series(baseline.with_baselines(views.facts(spark, sf_dir), one_row_per_week=True), kind, states)
    return points.select("year", "mmwr_week", six("value"), "n_missing_baseline", "selection")


@query
def series_dev_avg(spark, sf_dir):
    return _deviation_series(spark, sf_dir, "deviation_avg")


@query
def series_dev_expected(spark, sf_dir):
    return _deviation_series(spark, sf_dir, "deviation_expected", ["Alabama", "Alaska"])


@query
def series_endpoints(spark, sf_dir):
    return series.endpoints(series.series(views.weekly(spark, sf_dir), "raw"))


@query
def year_band(spark, sf_dir):
    # years spread around every band edge
    rows = views.weekly(spark, sf_dir).withColumn("year", F.col("year") - 2015 + 2014 + (F.col("nk") % 7))
    band, colour = series.year_band(F.col("year"))
    return rows.groupBy("year", band.alias("period"), colour.alias("colour")).agg(F.count(F.lit(1)).alias("n"))


@query
def excess_vs_baseline(spark, sf_dir):
    rows = baseline.excess_vs_baseline(views.facts(spark, sf_dir))
    return rows.select("week", six("actual"), six("baseline"), six("excess"))


# --- headline metrics --------------------------------------------------------


def _dashboard(spark, sf_dir):
    return baseline.with_baselines(_facts_with_population(spark, sf_dir), one_row_per_week=True)


@query
def metric_total(spark, sf_dir):
    return metrics.headline(views.weekly(spark, sf_dir)).select("total_deaths")


@query
def metric_period_rates(spark, sf_dir):
    """The last two years stand for 2023 and 2024."""
    rows = _facts_with_population(spark, sf_dir)
    rows = rows.withColumn("year", F.when(F.col("year") >= 2020, F.col("year") + 3).otherwise(F.col("year")))
    row = metrics.headline(rows)
    return row.select(*(six(c) for c in row.columns if c.startswith("rate_")))


@query
def metric_excess(spark, sf_dir):
    return metrics.headline(_dashboard(spark, sf_dir)).select("total_above_avg", "total_above_expected")


@query
def metric_selection(spark, sf_dir):
    row = metrics.headline(_dashboard(spark, sf_dir), ["Alabama", "New York"])
    return row.select(
        "total_deaths", "rate_2015_2019", "rate_2020_2022", "rate_2023_2025", "total_above_avg", "total_above_expected"
    )


@query
def metric_by_name(spark, sf_dir):
    rows = _dashboard(spark, sf_dir)
    known = metrics.metric(rows, ["All States"], "total_above_avg")
    return known.unionByName(metrics.metric(rows, ["All States"], "no such metric"))


# --- checks and reports ------------------------------------------------------


@query
def validate_yoy(spark, sf_dir):
    rows = quality.validate_yoy(views.facts(spark, sf_dir))
    return rows.select(
        "scope", "name", "total_before", "total_after", "states_before", "states_after", six("change_pct"), "status", "report"
    )


@query
def state_yoy(spark, sf_dir):
    rows = quality.state_yoy(views.uneven(spark, sf_dir))
    return rows.select("state", "total_before", "total_after", six("change_pct"))


@query
def entity_yoy(spark, sf_dir):
    rows = quality.entity_yoy(views.facts(spark, sf_dir))
    return rows.select("state", "total_before", "total_after", six("change_pct"))


@query
def coverage_diff(spark, sf_dir):
    return quality.coverage_diff(views.uneven(spark, sf_dir))


@query
def top5_yoy(spark, sf_dir):
    """The largest state of 2019 has no rows of 2018."""
    rows = views.facts(spark, sf_dir)
    rows = rows.withColumn("deaths", F.when(F.col("nk") == 6, F.col("deaths") * 100).otherwise(F.col("deaths")))
    rows = quality.top_changes(rows.filter(~((F.col("nk") == 6) & (F.col("year") == 2018))))
    return rows.select("state", "total_before", "total_after", six("change_pct"), "note")


@query
def top10_states(spark, sf_dir):
    return quality.top_states(views.facts(spark, sf_dir))


@query
def yearly_totals(spark, sf_dir):
    return quality.yearly_totals(views.weekly(spark, sf_dir))


def _national(spark, sf_dir):
    """National rows whose population grows by 7 a week."""
    rows = _facts_with_population(spark, sf_dir).filter(F.col("state") == NATIONAL)
    return rows.withColumn("population", F.col("population") + F.col("week") * 7)


@query
def yearly_rate(spark, sf_dir):
    rows = _national(spark, sf_dir)
    report = quality.yearly_rate(rows)
    return report.select("year", "deaths", "population", six("rate_per_100k"))


@query
def coverage_2019(spark, sf_dir):
    rows = quality.coverage(views.weekly(spark, sf_dir))
    return rows.select("states_with_data", "states_with_full_year", six("average_weeks_per_state"))


@query
def weeks_per_state(spark, sf_dir):
    return quality.weeks_per_state(views.weekly(spark, sf_dir))


@query
def weeks_per_year(spark, sf_dir):
    return quality.weeks_per_year(combine.union_sources(views.two_sources(spark, sf_dir)))


@query
def dataset_info(spark, sf_dir):
    return quality.dataset_info(views.weekly(spark, sf_dir))


@query
def distinct_lists(spark, sf_dir):
    return quality.distinct_lists(combine.union_sources(views.two_sources(spark, sf_dir)))


@query
def presence_check(spark, sf_dir):
    return quality.presence(views.facts(spark, sf_dir).filter(F.col("state") == NATIONAL))


@query
def entity_first_weeks(spark, sf_dir):
    return quality.entity_first_weeks(views.facts(spark, sf_dir))


@query
def entity_total(spark, sf_dir):
    folded = fold.fold_entities(views.foldable(spark, sf_dir).drop("nk"))
    return quality.entity_total(folded)


@query
def summary_stats(spark, sf_dir):
    merged = combine.union_sources(views.two_sources(spark, sf_dir))
    best = combine.dedup_best(merged)
    row = quality.summary(best, "state")
    yearly = F.transform(
        F.map_entries("yearly_totals"),
        lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string")),
    )
    return row.select(
        "data_type",
        "total_records",
        "years_covered",
        "total_deaths",
        F.array_join("data_sources", ",").alias("data_sources"),
        "states_count",
        F.array_join("state_coverage", ",").alias("state_coverage"),
        F.col("coverage_2019.states_with_data").alias("states_with_data"),
        F.col("coverage_2019.states_with_full_year").alias("states_with_full_year"),
        round_half_even(F.col("coverage_2019.average_weeks_per_state"), 6).alias("average_weeks_per_state"),
        F.array_join(yearly, ",").alias("yearly_totals"),
    )


@query
def summary_national(spark, sf_dir):
    row = quality.summary(views.facts(spark, sf_dir).filter(F.col("state") == NATIONAL).withColumn("data_source", F.lit("orders")), "national")
    yearly = F.transform(
        F.map_entries("yearly_totals"),
        lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string")),
    )
    return row.select(
        "data_type", "total_records", "years_covered", "total_deaths", F.array_join("data_sources", ",").alias("data_sources"),
        F.array_join(yearly, ",").alias("yearly_totals"),
    )


@query
def report_text(spark, sf_dir):
    return quality.yearly_rate(_national(spark, sf_dir)).select("year", "report")


# --- ingestion of raw layouts ------------------------------------------------


@query
def ingest_dated_file(spark, sf_dir):
    return ingest.ingest_dated_file(views.raw_dated_file(spark, sf_dir))


@query
def ingest_dated_file_parity(spark, sf_dir):
    return ingest.ingest_dated_file(views.raw_dated_file(spark, sf_dir), PARITY)


@query
def ingest_country_series(spark, sf_dir):
    return ingest.ingest_country_series(views.raw_country_series(spark, sf_dir))


@query
def ingest_country_series_parity(spark, sf_dir):
    return ingest.ingest_country_series(views.raw_country_series(spark, sf_dir), PARITY)


@query
def ingest_provisional(spark, sf_dir):
    return ingest.ingest_provisional(views.raw_provisional(spark, sf_dir))


@query
def ingest_provisional_parity(spark, sf_dir):
    return ingest.ingest_provisional(views.raw_provisional(spark, sf_dir), PARITY)


@query
def ingest_packed_week(spark, sf_dir):
    return ingest.ingest_packed_week(views.raw_packed_week(spark, sf_dir))


# --- scans, sinks and the whole batch ----------------------------------------


@query
def scan_csv_(spark, sf_dir):
    path = views.scratch(spark, "scan")
    rows = views.weekly(spark, sf_dir).select("year", "week", "state", "week_ending_date", "deaths")
    rows.write.mode("overwrite").option("header", True).csv(path)
    text = scan_csv(spark, path)
    return text.select(
        to_number(F.col("year")).cast("int").alias("year"),
        to_number(F.col("week")).cast("int").alias("week"),
        "state",
        "week_ending_date",
        to_number(F.col("deaths")).cast("bigint").alias("deaths"),
    )


def _finished(spark, sf_dir):
    cleaned = views.facts(spark, sf_dir).withColumn("data_source", F.lit("orders")).drop("nk")
    return finish_facts(cleaned.withColumn("deaths", F.col("deaths").cast("double")), views.facts_population(spark, sf_dir))


@query
def compile_national(spark, sf_dir):
    return filters.split_national_state(_finished(spark, sf_dir))[0]


@query
def compile_states(spark, sf_dir):
    return filters.split_national_state(_finished(spark, sf_dir))[1]


@query
def sink_national(spark, sf_dir):
    written = write_outputs(_finished(spark, sf_dir), views.scratch(spark, "out"))
    return scan_compiled(spark, written["national"])


@query
def sink_states(spark, sf_dir):
    path = views.scratch(spark, "states")
    states = filters.split_national_state(_finished(spark, sf_dir))[1]
    write_csv(states, path, ["year", "week", "state"])
    return scan_compiled(spark, path)


def _compiled(spark, sf_dir, rules: Rules):
    return compile_facts(views.raw_sources(spark, sf_dir), views.facts_population(spark, sf_dir), rules)


@query
def flagship_compile(spark, sf_dir):
    return _compiled(spark, sf_dir, DEFAULT)


@query
def flagship_compile_parity(spark, sf_dir):
    return _compiled(spark, sf_dir, PARITY)


def _landing(spark, sf_dir):
    """Lands three of the four sources, one without a column it needs, and runs the batch."""
    root = views.scratch(spark, "landing")
    sources = views.raw_sources(spark, sf_dir)
    sources["packed_week"] = sources["packed_week"].drop("age")
    for name in ("dated_file", "packed_week", "provisional"):
        sources[name].write.mode("overwrite").option("header", True).csv(f"{root}/in/{name}")
    return compile_landing(spark, f"{root}/in", views.facts_population(spark, sf_dir), f"{root}/out")


@query
def flagship_landing(spark, sf_dir):
    return scan_compiled(spark, _landing(spark, sf_dir)["states"])


@query
def flagship_landing_counts(spark, sf_dir):
    counts = scan_csv(spark, _landing(spark, sf_dir)["counts"])
    return counts.select(F.col("step").cast("int").alias("step"), "stage", F.col("rows").cast("bigint").alias("rows"))


def _land(sources, root):
    for name, rows in sources.items():
        rows.write.mode("overwrite").option("header", True).csv(f"{root}/{name}")


@query
def rejected_rows_(spark, sf_dir):
    """All four sources landed: how many rows each loses where, and why."""
    root = views.scratch(spark, "rejected")
    _land(views.raw_sources(spark, sf_dir), f"{root}/in")
    written = compile_landing(spark, f"{root}/in", views.facts_population(spark, sf_dir), f"{root}/out")
    return scan_csv(spark, written["rejects"]).select("source", "stage", "reason", F.col("rows").cast("bigint").alias("rows"))


@query
def malformed_lines(spark, sf_dir):
    """A source whose lines are short, long, cut by an open quote or well formed; the malformed ones with their rows."""
    root = views.scratch(spark, "malformed")
    views.broken_lines(spark, sf_dir).write.mode("overwrite").options(header=True, sep="\x01", quote="").csv(f"{root}/in/provisional")
    compile_landing(spark, f"{root}/in", views.facts_population(spark, sf_dir), f"{root}/out")
    gone = rejected_rows(spark, f"{root}/out").filter(F.col("reason") == reject.MALFORMED_LINE)
    return gone.groupBy("source", F.col("raw").alias("line")).agg(F.count(F.lit(1)).alias("rows"))


@query
def recompile_revised(spark, sf_dir):
    """One source is replaced after a full run; only the years that it touches are compiled again."""
    root = views.scratch(spark, "revised")
    sources, population = views.raw_sources(spark, sf_dir), views.facts_population(spark, sf_dir)
    _land(sources, f"{root}/in")
    compile_landing(spark, f"{root}/in", population, f"{root}/out")
    _land({"packed_week": views.revised_packed_week(sources["packed_week"])}, f"{root}/in")
    written = compile_landing(spark, f"{root}/in", population, f"{root}/out", changed_only=True)
    return scan_compiled(spark, written["compiled"], "parquet")


@query
def sink_empty_extract(spark, sf_dir):
    """Facts without a national row: the extract is there, and empty."""
    states = filters.split_national_state(_finished(spark, sf_dir))[1]
    written = write_outputs(states, views.scratch(spark, "empty"))
    parts = [scan_compiled(spark, written[name]).select(F.lit(name).alias("extract"), "state") for name in ("national", "states")]
    counted = parts[0].unionByName(parts[1]).groupBy("extract").agg(F.count(F.lit(1)).alias("rows"))
    names = spark.createDataFrame([("national",), ("states",)], "extract string")
    return names.join(counted, "extract", "left").select("extract", F.coalesce("rows", F.lit(0)).alias("rows"))


@query
def source_conflicts(spark, sf_dir):
    """Which source displaces which where they overlap, and how far their counts differ."""
    raw = views.raw_sources(spark, sf_dir)
    merged = combine.union_sources([ingest_(raw[name], DEFAULT) for name, ingest_ in SOURCES.items()])
    return reject.source_conflicts(reject.mark_cleaning(merged))


@query
def flagship_deviation(spark, sf_dir):
    """Two sources to the deviation series of the weeks that have a population."""
    best = combine.dedup_best(combine.union_sources(views.two_sources(spark, sf_dir)))
    rows = pop.with_rate(pop.attach_population(best, views.population(spark, sf_dir)))
    rows = baseline.with_baselines(rows, one_row_per_week=True)
    points = series.series(rows.filter(F.col("mortality_rate_per_100k") > 0), "deviation_avg")
    return points.select("year", "mmwr_week", six("value"), "n_missing_baseline", "selection")
