"""Seasonal baselines, growth-adjusted expectation and deviations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweek.operators.filters import is_national

BASE_YEARS = (2015, 2019)
BASE_YEAR = 2015
GROWTH_FACTOR = 1.0131
SEASON = ["state", "mmwr_week"]


def seasonal_baseline(
    facts: DataFrame, years: tuple[int, int] = BASE_YEARS, base_year: int = BASE_YEAR
) -> DataFrame:
    """Mean count per state and week: over a span of years, and in one year.

    Both means come from one pass over the years that matter.
    """
    in_span = F.col("year").between(*years)
    in_base = F.col("year") == base_year
    means = facts.filter(in_span | in_base).dropna(subset=SEASON).groupBy(*SEASON)
    return means.agg(
        F.avg(F.when(in_span, F.col("deaths"))).alias("avg_2015_2019"),
        F.avg(F.when(in_base, F.col("deaths"))).alias("baseline_2015"),
    )


def with_expected(df: DataFrame, base_year: int = BASE_YEAR, growth: float = GROWTH_FACTOR) -> DataFrame:
    """Expectation: the base year's count grown by a fixed rate per year."""
    years = F.col("year") - F.lit(base_year)
    factor = F.pow(F.lit(growth), years)
    return df.withColumns(
        {
            "years_from_2015": years,
            "growth_factor": factor,
            "expected_deaths": F.col("baseline_2015") * factor,
        }
    )


def _attach_means(facts: DataFrame, years: tuple[int, int], base_year: int, one_row_per_week: bool) -> DataFrame:
    if not one_row_per_week:
        return facts.join(seasonal_baseline(facts, years, base_year), SEASON, "left")
    ordered = Window.partitionBy(*SEASON).orderBy("year")
    season = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = F.col("state").isNotNull() & F.col("mmwr_week").isNotNull()
    message = F.concat(F.lit("more than one row of state, week "), F.concat_ws(", ", *SEASON), F.lit(" in one year"))
    # a year that follows itself, and every row of its group knows
    facts_of = facts.withColumn("_again", F.lag("year").over(ordered) == F.col("year"))
    again = F.coalesce(F.max("_again").over(season), F.lit(False))

    def mean(of_years):
        average = F.avg(F.when(of_years, F.col("deaths"))).over(season)
        return F.when(known & again, F.raise_error(message).cast("double")).when(known, average)

    return facts_of.withColumns(
        {
            "avg_2015_2019": mean(F.col("year").between(*years)),
            "baseline_2015": mean(F.col("year") == base_year),
        }
    ).drop("_again")


def with_baselines(
    facts: DataFrame,
    years: tuple[int, int] = BASE_YEARS,
    base_year: int = BASE_YEAR,
    growth: float = GROWTH_FACTOR,
    one_row_per_week: bool = False,
) -> DataFrame:
    """Facts with both baselines, the expectation and both deviations.

    In general the baseline is aggregated (map-side combined, one row per state
    and week) and joined back, which reads the facts twice but copes with any
    number of rows per state and week. Compiled facts hold one row per state,
    year and week; say so with ``one_row_per_week``, and the means are taken
    over a window instead: a group is then as long as the list of years, and
    the facts, with everything that produces them, are computed once. A week
    with two rows of one year would count that year twice, so it is an error,
    found by the same window and raised when a baseline is computed.
    """
    df = with_expected(_attach_means(facts, years, base_year, one_row_per_week), base_year, growth)
    return df.withColumns(
        {
            "deviation_from_avg": F.col("deaths") - F.col("avg_2015_2019"),
            "deviation_from_expected": F.col("deaths") - F.col("expected_deaths"),
        }
    )


def excess_vs_baseline(
    facts: DataFrame, year: int = 2020, baseline_years: Sequence[int] = (2017, 2018, 2019)
) -> DataFrame:
    """National weekly excess of one year over the mean of earlier years.

    Weeks known to either side appear; where the other side is missing the
    excess is null. Both sides are conditional aggregates of one pass, which
    aligns them by week without a join. National rows are unique per week.
    """
    in_year = F.col("year") == year
    in_base = F.col("year").isin(list(baseline_years))
    return (
        facts.filter(is_national() & (in_year | in_base))
        .dropna(subset=["week"])
        .groupBy("week")
        .agg(
            F.sum(F.when(in_year, F.col("deaths"))).cast("double").alias("actual"),
            F.avg(F.when(in_base, F.col("deaths"))).alias("baseline"),
        )
        .withColumn("excess", F.col("actual") - F.col("baseline"))
    )
