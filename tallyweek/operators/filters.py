"""Row predicates and selections."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.schema import JURISDICTIONS, NATIONAL, NATIONAL_VARIANTS

ALL_STATES = "All States"


def valid_measure(df: DataFrame, measure: str = "deaths") -> DataFrame:
    """Present and positive."""
    return df.filter(F.col(measure) > 0)


def valid_week(df: DataFrame, week: str = "week", last: int = 53) -> DataFrame:
    """Above 0 and at most 53; a fractional week passes and is truncated later."""
    return df.filter((F.col(week) > 0) & (F.col(week) <= last))


def of_country(df: DataFrame, country: str = NATIONAL) -> DataFrame:
    return df.filter(F.col("country_name") == country)


def exclude_totals(df: DataFrame, names: Iterable[str] = tuple(NATIONAL_VARIANTS)) -> DataFrame:
    """Drop national totals but keep rows without a state, unlike SQL NOT IN."""
    return df.filter(~F.coalesce(F.col("state").isin(list(names)), F.lit(False)))


def valid_jurisdictions(df: DataFrame, names: Iterable[str] = tuple(JURISDICTIONS)) -> DataFrame:
    return df.filter(F.col("state").isin(list(names)))


def drop_missing(df: DataFrame, essentials: Sequence[str]) -> DataFrame:
    return df.dropna(subset=[c for c in essentials if c in df.columns])


def is_national() -> Column:
    """True on national rows, false on all others, also on rows without a state."""
    return F.coalesce(F.col("state") == NATIONAL, F.lit(False))


def side() -> Column:
    """Which of the two output tables a row belongs to."""
    return F.when(is_national(), F.lit("national")).otherwise(F.lit("state"))


def split_national_state(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(national rows, all other rows). Split a stored table, not a long plan."""
    return df.filter(F.col("state") == NATIONAL), df.filter(~is_national())


def select_states(df: DataFrame, states: Sequence[str] = (ALL_STATES,)) -> DataFrame:
    """Rows of the chosen states.

    Nothing chosen, or exactly the "all" entry, means no filter. Beside other
    names the "all" entry is just a name that matches nothing.
    """
    if not states or list(states) == [ALL_STATES]:
        return df
    return df.filter(F.col("state").isin(list(states)))


def selection_label(states: Sequence[str] = (ALL_STATES,)) -> str:
    if not states or list(states) == [ALL_STATES]:
        return "All States Combined"
    return ", ".join(states)


def state_choices(df: DataFrame) -> DataFrame:
    """Options of a state picker: the "all" entry first, then names in order."""
    names = df.select("state").filter(F.col("state").isNotNull()).distinct()
    first = df.sparkSession.range(1).select(F.lit(0).alias("rank"), F.lit(ALL_STATES).alias("state"))
    return first.unionByName(names.select(F.lit(1).alias("rank"), "state")).orderBy("rank", "state")
