"""Headline metrics of a selection, all from one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.numbers import exact_total, per_100k, ratio, round_half_even, total
from tallyweek.operators.filters import ALL_STATES, select_states

WEEKS_PER_YEAR = 52.18
EXCESS_YEARS = (2020, 2022)
#: period -> number of years in the divisor; None counts the years present.
PERIODS = {(2015, 2019): 5, (2020, 2022): 3, (2023, 2025): None}


def _period_sums(period: tuple[int, int], has_population: bool) -> list[Column]:
    inside = F.col("year").between(*period)
    prefix = f"{period[0]}_{period[1]}"
    people = F.col("population") if has_population else F.lit(None).cast("double")
    return [
        total(F.when(inside, F.col("deaths"))).cast("double").alias(f"d_{prefix}"),
        total(F.when(inside, people)).cast("double").alias(f"p_{prefix}"),
        total(F.when(inside & people.isNotNull(), F.col("deaths"))).cast("double").alias(f"dp_{prefix}"),
        F.count(F.when(inside, 1)).alias(f"n_{prefix}"),
    ]


def headline(
    df: DataFrame, states: Sequence[str] = (ALL_STATES,), periods: dict[tuple[int, int], int | None] | None = None
) -> DataFrame:
    """One row: total count, a rate per period, and positive excess totals.

    ``rate_<period>`` is the published figure: mean weekly rate scaled by row
    count. ``rate_pooled_weekly_<period>`` and ``rate_pooled_annual_<period>``
    are its plain pooled counterparts over rows with a population. A period
    without rows or population yields 0.

    Rows are reduced to one per year first, so no distinct count runs over the
    facts.
    """
    periods = PERIODS if periods is None else periods
    chosen = select_states(df, states)
    has_population = "population" in df.columns
    yearly = [exact_total(F.col("deaths")).alias("deaths")]
    for period in periods:
        yearly += _period_sums(period, has_population)
    for name in ("avg", "expected"):
        column = f"deviation_from_{name}"
        if column in df.columns:
            inside = F.col("year").between(*EXCESS_YEARS) & (F.col(column) > 0)
            yearly.append(exact_total(F.when(inside, F.col(column))).alias(f"above_{name}"))
    sums = chosen.groupBy("year").agg(*yearly)
    overall = [total(F.col("deaths")).cast("bigint").alias("total_deaths")]
    for period, span in periods.items():
        prefix = f"{period[0]}_{period[1]}"
        deaths, people = F.sum(f"d_{prefix}"), F.sum(f"p_{prefix}")
        rows = F.sum(f"n_{prefix}")
        years = F.lit(span) if span else F.count(F.when(F.col(f"n_{prefix}") > 0, 1))
        rate = ratio(deaths, people) * 100000.0 * rows
        overall.append(
            F.coalesce(round_half_even(ratio(rate, years * F.lit(WEEKS_PER_YEAR))), F.lit(0.0)).alias(
                f"rate_{prefix}"
            )
        )
        pooled = F.coalesce(per_100k(F.sum(f"dp_{prefix}"), people), F.lit(0.0))
        overall.append(pooled.alias(f"rate_pooled_weekly_{prefix}"))
        overall.append((pooled * F.lit(WEEKS_PER_YEAR)).alias(f"rate_pooled_annual_{prefix}"))
    for name in ("avg", "expected"):
        if f"deviation_from_{name}" in df.columns:
            overall.append(
                F.coalesce(F.sum(f"above_{name}"), F.lit(0)).cast("bigint").alias(f"total_above_{name}")
            )
    return sums.agg(*overall)


#: The published names.
METRICS = {
    "total_deaths": "total_deaths",
    "deaths_per_100k_2015_2019": "rate_2015_2019",
    "deaths_per_100k_2020_2022": "rate_2020_2022",
    "deaths_per_100k_2023_2025": "rate_2023_2025",
    "total_above_avg": "total_above_avg",
    "total_above_expected": "total_above_expected",
}


def metric(df: DataFrame, states: Sequence[str], name: str) -> DataFrame:
    """One named metric as (metric, value); an unknown name has the value 0."""
    row = headline(df, states)
    label = F.lit(name).alias("metric")
    if METRICS.get(name) in row.columns:
        return row.select(label, F.col(METRICS[name]).cast("double").alias("value"))
    return df.sparkSession.range(1).select(label, F.lit(0.0).alias("value"))
