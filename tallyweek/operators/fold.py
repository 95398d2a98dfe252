"""Folding a city into its parent state, and the national roll-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.columns import keep_available
from tallyweek.functions.numbers import total
from tallyweek.schema import CITY, CITY_ABBREVIATION, CITY_PARENT, LABEL_ROLLUP, NATIONAL, SOURCE_COLUMNS


def _is_child(children: Sequence[str]) -> Column:
    matches = [F.col("state").contains(name) for name in children]
    found = matches[0]
    for match in matches[1:]:
        found = found | match
    return F.coalesce(found, F.lit(False))


def fold_entities(
    df: DataFrame,
    into: str = CITY_PARENT,
    children: Sequence[str] = (CITY, CITY_ABBREVIATION),
    measure: str = "deaths",
    how: str = "sum",
) -> DataFrame:
    """Fold child entities (matched by case-sensitive substring) into a parent.

    * "sum": children are renamed and the measure is summed over all other
      columns, for every state; missing keys form groups of their own. One rule
      for all data: no row changes what becomes of the rows of another key.
    * "data": the historical rule. Children are renamed; rows are summed only if
      child and parent both occur anywhere. That is found out inside the plan,
      by one aggregate over the same rows, when the result is computed.
    * "none": rows stay as they are.

    Sums are combined map-side, so one state holding most of the rows costs one
    partial row per task and week.
    """
    if how == "none":
        return df
    if how not in ("sum", "data"):
        raise ValueError(f"unknown fold {how!r}")
    renamed = df.withColumn("state", F.when(_is_child(children), F.lit(into)).otherwise(F.col("state")))
    keys = [c for c in df.columns if c not in (measure, "row_ord")]
    if how == "sum":
        return renamed.groupBy(*keys).agg(total(F.col(measure)).alias(measure)).select(*keys, measure)
    both = df.agg(F.coalesce(F.max(_is_child(children)) & F.max(F.col("state") == into), F.lit(False))).scalar()
    # a row that is not to be summed is a group of its own
    own = renamed.withColumns({"_both": both, "_own": F.monotonically_increasing_id()})
    own = own.withColumn("_own", F.when(~F.col("_both"), F.col("_own")))
    rest = [F.when(~F.col("_both"), F.first("row_ord")).alias("row_ord")] if "row_ord" in df.columns else []
    value = F.when(F.col("_both"), total(F.col(measure))).otherwise(F.sum(measure)).alias(measure)
    return own.groupBy(*keys, "_both", "_own").agg(value, *rest).select(*df.columns)


def first_per_entity(df: DataFrame, columns: Sequence[str], order: Sequence[str], entity: str = "state") -> DataFrame:
    """First non-missing value of each column per entity, in an explicit order."""
    position = F.struct(*order)
    # one row per place and value by hashing; only these are put in order
    known = df.groupBy(entity, *dict.fromkeys([*order, *columns])).agg(F.count(F.lit(1)).alias("_rows"))
    return known.groupBy(entity).agg(
        *(F.min_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in columns)
    )


def attach_first(df: DataFrame, source: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Re-attach per-entity first values to a folded table."""
    return df.join(first_per_entity(source, columns, order), "state", "left")


def national_rollup(df: DataFrame, order: Sequence[str] = ("state",)) -> DataFrame:
    """National weekly totals from state rows; rows without a week are left out."""
    keys = ["year", "week", "mmwr_week"]
    rows = df.dropna(subset=keys)
    if "week_ending_date" in df.columns:
        # dates are few per week and state: a hash aggregate leaves one row for each before the first is taken
        rows = rows.groupBy(*keys, *order, "week_ending_date").agg(total(F.col("deaths")).alias("deaths"))
    sums = [total(F.col("deaths")).alias("deaths")]
    if "week_ending_date" in df.columns:
        dated = F.when(F.col("week_ending_date").isNotNull(), F.struct(*order, "week_ending_date"))
        sums.append(F.min_by("week_ending_date", dated).alias("week_ending_date"))
    weekly = rows.groupBy(*keys).agg(*sums)
    weekly = weekly.withColumns({"state": F.lit(NATIONAL), "data_source": F.lit(LABEL_ROLLUP)})
    return keep_available(weekly, SOURCE_COLUMNS)
