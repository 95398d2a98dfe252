"""Year-over-year checks, coverage and summary reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.numbers import (
    pct_change,
    per_100k,
    round_half_even,
    signed_pct_text,
    thousands_text,
    total,
)
from tallyweek.operators.filters import split_national_state
from tallyweek.schema import CITY_PARENT

ENTITY_LIMIT_PCT = 10.0
OVERALL_LIMIT_PCT = 5.0
FULL_YEAR_WEEKS = 52


def state_totals(facts: DataFrame, before: int = 2018, after: int = 2019) -> DataFrame:
    """Both years' totals per state, national rows left out, from one pass.

    A state absent from a year has null there.
    """
    _, states = split_national_state(facts)
    in_before, in_after = F.col("year") == before, F.col("year") == after
    return (
        states.filter(in_before | in_after)
        .dropna(subset=["state"])
        .groupBy("state")
        .agg(
            F.when(F.count(F.when(in_before, 1)) > 0, total(F.when(in_before, F.col("deaths")))).alias("total_before"),
            F.when(F.count(F.when(in_after, 1)) > 0, total(F.when(in_after, F.col("deaths")))).alias("total_after"),
        )
    )


def state_yoy(facts: DataFrame, before: int = 2018, after: int = 2019) -> DataFrame:
    return state_totals(facts, before, after).withColumn(
        "change_pct", pct_change(F.col("total_before"), F.col("total_after"))
    )


def entity_yoy(facts: DataFrame, entity: str = CITY_PARENT, before: int = 2018, after: int = 2019) -> DataFrame:
    """One state's change; no row unless both years have it."""
    rows = state_yoy(facts.filter(F.col("state") == entity), before, after)
    return rows.dropna(subset=["total_before", "total_after"])


def validate_yoy(
    facts: DataFrame,
    entity: str = CITY_PARENT,
    before: int = 2018,
    after: int = 2019,
    entity_limit: float = ENTITY_LIMIT_PCT,
    overall_limit: float = OVERALL_LIMIT_PCT,
) -> DataFrame:
    """Change of one state and of all states, each flagged against its limit.

    Empty when either year has no state rows; no entity row unless both years
    have it. Both lines come from the same pass.
    """
    is_entity = F.col("state") == entity
    sums = state_totals(facts, before, after).agg(
        F.sum("total_before").alias("b_all"),
        F.sum("total_after").alias("a_all"),
        F.count("total_before").alias("nb_all"),
        F.count("total_after").alias("na_all"),
        F.max(F.when(is_entity, F.col("total_before"))).alias("b_one"),
        F.max(F.when(is_entity, F.col("total_after"))).alias("a_one"),
    )
    one_state = F.lit(1).cast("bigint")
    checks = F.array(
        F.struct(
            F.lit("entity").alias("scope"),
            F.lit(entity).alias("name"),
            F.col("b_one").alias("total_before"),
            F.col("a_one").alias("total_after"),
            one_state.alias("states_before"),
            one_state.alias("states_after"),
            F.lit(float(entity_limit)).alias("limit_pct"),
        ),
        F.struct(
            F.lit("overall").alias("scope"),
            F.lit("all states").alias("name"),
            F.col("b_all").alias("total_before"),
            F.col("a_all").alias("total_after"),
            F.col("nb_all").alias("states_before"),
            F.col("na_all").alias("states_after"),
            F.lit(float(overall_limit)).alias("limit_pct"),
        ),
    )
    rows = (
        sums.filter((F.col("nb_all") > 0) & (F.col("na_all") > 0))
        .select(F.inline(checks))
        .dropna(subset=["total_before", "total_after"])
        .withColumn("change_pct", pct_change(F.col("total_before"), F.col("total_after")))
    )
    return rows.withColumns(
        {
            "status": F.when(F.abs("change_pct") > F.col("limit_pct"), F.lit("warning")).otherwise(F.lit("reasonable")),
            "report": F.concat(
                F.col("name"),
                F.lit(": "),
                thousands_text(F.col("total_before")),
                F.lit(" -> "),
                thousands_text(F.col("total_after")),
                F.lit(" ("),
                signed_pct_text(F.col("change_pct")),
                F.lit(")"),
            ),
        }
    )


def coverage_diff(facts: DataFrame, before: int = 2018, after: int = 2019) -> DataFrame:
    """States present in only one of two years: both anti-joins in one pass."""
    totals = state_totals(facts, before, after)
    gone, new = F.col("total_after").isNull(), F.col("total_before").isNull()
    side = F.when(gone, F.lit(f"missing in {after}")).when(new, F.lit(f"new in {after}"))
    return totals.select("state", side.alias("side")).filter(F.col("side").isNotNull())


def top_changes(facts: DataFrame, n: int = 5, before: int = 2018, after: int = 2019) -> DataFrame:
    """Largest states of the later year with their change; ties by name."""
    totals = state_totals(facts, before, after).filter(F.col("total_after").isNotNull())
    top = totals.orderBy(F.desc("total_after"), F.asc("state")).limit(n)
    change = pct_change(F.col("total_before"), F.col("total_after"))
    return top.select(
        "state",
        "total_before",
        "total_after",
        change.alias("change_pct"),
        F.when(F.col("total_before").isNull(), F.lit(f"new in {after}"))
        .otherwise(F.concat(signed_pct_text(change), F.lit(f" vs {before}")))
        .alias("note"),
    )


def top_states(facts: DataFrame, year: int = 2019, n: int = 10) -> DataFrame:
    """States with the most deaths in a year; ties by name."""
    _, states = split_national_state(facts)
    totals = states.filter(F.col("year") == year).dropna(subset=["state"]).groupBy("state")
    return totals.agg(total(F.col("deaths")).alias("deaths")).orderBy(F.desc("deaths"), F.asc("state")).limit(n)


def yearly_totals(facts: DataFrame) -> DataFrame:
    return facts.dropna(subset=["year"]).groupBy("year").agg(total(F.col("deaths")).alias("deaths"))


def yearly_rate(national: DataFrame) -> DataFrame:
    """National report: deaths, the first week's population and the year's rate."""
    first_week = F.struct("week", "state")
    weekly = national.groupBy("year", "week", "state", "population").agg(total(F.col("deaths")).alias("deaths"))
    yearly = weekly.groupBy("year").agg(
        total(F.col("deaths")).alias("deaths"), F.min_by("population", first_week).alias("population")
    )
    rate = per_100k(F.col("deaths"), F.col("population"))
    # fixed values: the wording of the published line
    line = F.concat(F.col("year"), F.lit(": "), thousands_text(F.col("deaths")), F.lit(" deaths"))
    detail = F.concat(
        F.lit(" | Pop: "),
        thousands_text(F.col("population")),
        F.lit(" | Rate: "),
        F.format_string("%.1f", round_half_even(rate)),
        F.lit(" per 100k"),
    )
    return yearly.withColumns(
        {"rate_per_100k": rate, "report": F.concat(line, F.coalesce(detail, F.lit("")))}
    )


def week_bits(condition: Column | None = None, week: str = "week") -> tuple[Column, Column]:
    """(slice, bits): the slice of 64 weeks that a week lies in, and an aggregate of the weeks of a slice as bits.

    Weeks are whole numbers; those of a cleaned table all lie in slice 0. A set of weeks is 8 bytes that combine
    before the shuffle, where a list or a distinct aggregate would move the weeks themselves. A row without a week,
    or that does not meet the condition, adds none.
    """
    # the function takes a plain number of places; in SQL it varies by row
    bits = F.expr(f"shiftleft(1L, CAST(pmod(CAST(`{week}` AS BIGINT), 64) AS INT))")
    return F.floor(F.col(week).cast("long") / 64), F.bit_or(bits if condition is None else F.when(condition, bits))


def distinct_weeks(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of different weeks per key, as ``weeks``."""
    part, bits = week_bits()
    sets = rows.groupBy(*keys, part.alias("_slice")).agg(bits.alias("_bits"))
    return sets.groupBy(*keys).agg(total(F.bit_count("_bits")).cast("bigint").alias("weeks"))


def weeks_per_state(facts: DataFrame, year: int = 2019) -> DataFrame:
    return distinct_weeks(facts.filter(F.col("year") == year).dropna(subset=["state"]), ["state"])


def coverage(facts: DataFrame, year: int = 2019, full: int = FULL_YEAR_WEEKS) -> DataFrame:
    """How many states report, how many for a full year, and weeks on average."""
    return weeks_per_state(facts, year).agg(
        F.count(F.lit(1)).alias("states_with_data"),
        F.count(F.when(F.col("weeks") >= full, 1)).alias("states_with_full_year"),
        F.avg("weeks").alias("average_weeks_per_state"),
    )


def weeks_per_year(facts: DataFrame) -> DataFrame:
    return distinct_weeks(facts, ["data_source", "year"])


def week_range(facts: DataFrame) -> DataFrame:
    return facts.agg(F.min("week").alias("first_week"), F.max("week").alias("last_week"))


def dataset_info(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count(F.lit(1)).alias("records"), F.min("year").alias("first_year"), F.max("year").alias("last_year")
    )


def distinct_lists(facts: DataFrame, columns: Sequence[str] = ("year", "state", "data_source")) -> DataFrame:
    """Distinct values of several columns as (name, value), in one pass."""
    pairs = F.array(
        *(F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns)
    )
    return facts.select(F.inline(pairs)).dropna().distinct()


def presence(facts: DataFrame, year: int = 2020, week: int = 1, total_year: int = 2019) -> DataFrame:
    """Is a given week there, which weeks of its year are, and a year's total.

    Weeks that no year has are not listed; their rows count in the total. Rows are reduced to one per year and week before the weeks are listed.
    """
    weekly = (
        facts.filter(F.col("year").isin(year, total_year))
        .groupBy("year", "week")
        .agg(F.count(F.lit(1)).alias("rows"), total(F.col("deaths")).alias("deaths"))
    )
    here = (F.col("year") == year) & (F.col("week") == week)
    listed = (F.col("year") == year) & F.col("week").between(1, 53)
    weeks = F.sort_array(F.collect_set(F.when(listed, F.col("week"))))
    return weekly.agg(
        total(F.when(here, F.col("rows"))).alias("rows_in_week"),
        F.sum(F.when(here, F.col("deaths"))).alias("deaths_in_week"),
        F.array_join(weeks.cast("array<string>"), ",").alias("weeks_in_year"),
        total(F.when(F.col("year") == total_year, F.col("deaths"))).alias("total_in_year"),
    )


def entity_first_weeks(facts: DataFrame, entity: str = CITY_PARENT, year: int = 2019, weeks: int = 5) -> DataFrame:
    """One state's totals in the first weeks of a year, weeks without any left out."""
    rows = facts.filter((F.col("state") == entity) & (F.col("year") == year) & F.col("week").between(1, weeks))
    weekly = rows.groupBy("week").agg(total(F.col("deaths")).alias("deaths"))
    return weekly.filter(F.col("deaths") > 0).orderBy("week")


def entity_total(facts: DataFrame, entity: str = CITY_PARENT) -> DataFrame:
    return facts.filter(F.col("state") == entity).agg(total(F.col("deaths")).alias("deaths"))


def summary(facts: DataFrame, data_type: str = "combined", year: int = 2019) -> DataFrame:
    """One row describing a table; state tables also list states and coverage.

    One pass: rows are reduced to state, year and source by hashing, their weeks to bits (``week_bits``), then grouped
    three ways at once (by year, by source, by state), then gathered. The lists hold one entry per state, source or
    year of a cleaned table, so the jurisdiction list bounds them. Sources come in order of first appearance.
    """
    part, bits = week_bits(F.col("year") == year)
    cells = facts.groupBy("state", "year", "data_source", part.alias("slice")).agg(
        F.count(F.lit(1)).alias("n"),
        total(F.col("deaths")).alias("d"),
        F.min("week").alias("first_week"),
        bits.alias("bits"),
    )
    by = ["year", "data_source", "state"]
    first = F.struct("year", "first_week", "state")
    # grouping sets blank the keys of the other sets, so keep the originals
    cells = cells.withColumn("first", first)
    level = F.grouping_id(*by, "slice")
    sets = cells.groupingSets([["year"], ["data_source"], ["state", "slice"]], *by, "slice").agg(
        level.alias("level"),
        F.sum("n").alias("n"),
        F.sum("d").alias("d"),
        F.min("first").alias("first"),
        F.bit_count(F.bit_or("bits")).alias("weeks"),
    )
    # a state's slices, one each in a cleaned table
    sets = sets.groupBy("level", *by).agg(
        F.sum("n").alias("n"), F.sum("d").alias("d"), F.min("first").alias("first"), total(F.col("weeks")).alias("weeks")
    )
    per_year, per_source, per_state = (F.col("level") == code for code in (0b0111, 0b1011, 0b1100))

    def listed(condition: Column, *columns: str) -> Column:
        return F.sort_array(F.collect_list(F.when(condition, F.struct(*columns))))

    covered = per_state & (F.col("weeks") > 0)
    row = sets.agg(
        F.lit(data_type).alias("data_type"),
        total(F.when(per_year, F.col("n"))).alias("total_records"),
        F.concat_ws("-", F.min("year"), F.max("year")).alias("years_covered"),
        F.sum(F.when(per_year, F.col("d"))).alias("total_deaths"),
        listed(per_source & F.col("data_source").isNotNull(), "first", "data_source")["data_source"].alias("data_sources"),
        F.map_from_entries(listed(per_year & F.col("year").isNotNull(), "year", "d")).alias("yearly_totals"),
        listed(per_state & F.col("state").isNotNull(), "state")["state"].alias("state_coverage"),
        F.count(F.when(covered, 1)).alias("states_with_data"),
        F.count(F.when(covered & (F.col("weeks") >= FULL_YEAR_WEEKS), 1)).alias("states_with_full_year"),
        F.avg(F.when(covered, F.col("weeks"))).alias("average_weeks_per_state"),
    ).filter(F.col("total_records") > 0)
    columns = ["data_type", "total_records", "years_covered", "total_deaths", "data_sources", "yearly_totals"]
    if data_type != "state":
        return row.select(*columns)
    cover = F.struct("states_with_data", "states_with_full_year", "average_weeks_per_state")
    return row.select(
        *columns,
        F.array_size("state_coverage").cast("bigint").alias("states_count"),
        "state_coverage",
        F.when(F.col("states_with_data") > 0, cover).alias(f"coverage_{year}"),
    )
