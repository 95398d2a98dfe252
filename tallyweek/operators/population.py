"""Population denominators: backward as-of lookup, rates and consistency."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweek.functions.numbers import per_100k, ratio, round_half_even, total
from tallyweek.operators.filters import is_national

MAX_YEARS_BACK = 4


def carry_forward(population: DataFrame, tolerance: int = MAX_YEARS_BACK) -> DataFrame:
    """The dimension with each estimate repeated for the years it may stand in for.

    Result: one row per (state, year) holding the latest estimate that is at
    most ``tolerance`` years old. Only the dimension is expanded, so the as-of
    lookup becomes a plain equality join for the facts.
    """
    known = population.filter(F.col("population").isNotNull() & F.col("year").isNotNull())
    reach = known.select(
        "state",
        "population",
        F.col("year").alias("as_of"),
        F.explode(F.sequence(F.col("year"), F.col("year") + F.lit(tolerance))).alias("year"),
    )
    # the count itself breaks ties between repeated estimates of one year
    latest = F.max_by("population", F.struct("as_of", "population"))
    return reach.groupBy("state", F.col("year").cast("int").alias("year")).agg(latest.alias("population"))


def attach_population(facts: DataFrame, population: DataFrame, tolerance: int = MAX_YEARS_BACK) -> DataFrame:
    """Facts with the exact or nearest earlier estimate; null when too old.

    No join hint: the planner broadcasts the dimension while its measured size
    allows it and otherwise joins by shuffle, splitting a state that holds most
    of the facts. A tolerance of 0 is the exact-year join.
    """
    facts = facts.drop("population")
    return facts.join(carry_forward(population, tolerance), ["year", "state"], "left")


def with_rate(df: DataFrame, name: str = "mortality_rate_per_100k") -> DataFrame:
    """Weekly count per 100 000 of annual population, one decimal, half to even."""
    return df.withColumn(name, round_half_even(per_100k(F.col("deaths"), F.col("population"))))


def population_coverage(df: DataFrame) -> DataFrame:
    """Share of rows with a population, and rows without a week."""
    missing_week = F.col("week").isNull() if "week" in df.columns else F.lit(True)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("population").alias("rows_with_population"),
        (ratio(F.count("population"), F.count(F.lit(1))) * 100.0).alias("coverage_pct"),
        F.count(F.when(missing_week, 1)).alias("rows_missing_week"),
    )


def population_gap(population: DataFrame) -> DataFrame:
    """Per year: the national estimate against the sum of its parts."""
    national = F.when(is_national(), F.col("population"))
    parts = F.when(~is_national(), F.col("population"))
    return population.groupBy("year").agg(
        F.sum(national).alias("national"),
        total(parts).alias("parts"),
        (F.sum(national) - total(parts)).alias("gap"),
    )


def population_runs(population: DataFrame, unit: int = 1000) -> DataFrame:
    """Estimates that were not made for their year: carried over from year to year, or rounded.

    One row per state and run of consecutive years with one value, where the run is longer than a year (``repeated``)
    or the value a multiple of ``unit`` (``rounded``). A year that is missing or stands twice ends a run; rows without
    state, year or value are left out.
    """
    known = population.dropna(subset=["state", "year", "population"]).select("state", "year", "population")
    in_order = Window.partitionBy("state").orderBy("year", "population")
    goes_on = (F.lag("population").over(in_order) == F.col("population")) & (F.lag("year").over(in_order) == F.col("year") - 1)
    marked = known.withColumn("_starts", F.when(goes_on, 0).otherwise(1))
    runs = marked.withColumn("_run", F.sum("_starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    found = runs.groupBy("state", "_run", "population").agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count(F.lit(1)).alias("years")
    )
    flags = found.withColumns({"repeated": F.col("years") > 1, "rounded": F.col("population") % unit == 0})
    return flags.filter("repeated OR rounded").select("state", "first_year", "last_year", "years", "population", "repeated", "rounded")
