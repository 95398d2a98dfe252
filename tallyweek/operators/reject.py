"""Why a row leaves the batch: each row is tagged with the first reason that applies.

A tagged table holds kept rows (``reason`` null) and rejected ones side by side, so one
pass computes both and one partitioned write keeps them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyweek.functions.columns import completeness, compute_once, with_week_pair
from tallyweek.functions.numbers import number_column
from tallyweek.operators.combine import ORDER_COLUMNS, RELABEL, best_first
from tallyweek.rules import DEFAULT, Rules
from tallyweek.schema import JURISDICTIONS

MALFORMED_LINE = "malformed line"
NATIONAL_TOTAL = "national total"
OTHER_COUNTRY = "other country"
NOT_WEEKLY = "not weekly"
OTHER_AGE = "other age group"
OUTSIDE_YEARS = "outside the years"
NO_VALID_WEEK = "no valid week"
NO_COUNT = "no count"
NOT_POSITIVE = "count not positive"
DATE_UNREAD = "date not understood"
NO_YEAR_OR_WEEK = "no year or week"
NO_STATE = "no state"
NOT_WHOLE = "year or week not a whole number"
UNKNOWN_STATE = "unknown state"
DUPLICATE = "less complete duplicate"
#: not a loss: the rows that the fold sums into another.
SUMMED = "summed into another row"


def unless(condition: Column) -> Column:
    """True where a condition does not hold, also where it is unknown."""
    return ~F.coalesce(condition, F.lit(False))


def first_reason(reasons: Mapping[str, Column]) -> Column:
    """The first reason whose condition holds, null if none does."""
    found = F.lit(None).cast("string")
    for reason, condition in reversed(reasons.items()):
        found = F.when(condition, F.lit(reason)).otherwise(found)
    return found


def kept(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("reason").isNull())


def mark_cleaning(
    merged: DataFrame, rules: Rules = DEFAULT, jurisdictions: Sequence[str] = tuple(JURISDICTIONS)
) -> DataFrame:
    """The cleaning step with every row kept: reason, and of duplicates the row that stays.

    Rows without a reason are those of ``combine.clean``. ``kept_source`` and ``kept_deaths`` are of the row that
    displaces a duplicate, from the same window that finds it. A row that has left before the dedup is a window
    group of its own, so rows without a key meet no hot group.
    """
    df = with_week_pair(merged)
    number = {c: number_column(df, c, rules.thousands) for c in ("year", "week", "mmwr_week", "deaths")}
    has_text = any(isinstance(df.schema[c].dataType, StringType) for c in number)
    df = compute_once(df, number) if has_text else df.withColumns(number)
    whole = {
        "year": F.col("year").try_cast("int"),
        "week": F.col("week").try_cast("int"),
        "mmwr_week": F.coalesce(F.col("mmwr_week"), F.col("week")).try_cast("int"),
    }
    unplaced = F.col("year").isNull() | F.col("week").isNull()
    dated = F.col("week_ending_date").isNotNull() if "week_ending_date" in df.columns else F.lit(False)
    state = F.col("state")
    relabelled = state
    for old, new in RELABEL.items():
        relabelled = F.when(state == old, F.lit(new)).otherwise(relabelled)
    known = relabelled.isin(list(jurisdictions)) if rules.relabel_first else state.isin([*jurisdictions, *RELABEL])
    reasons = {
        DATE_UNREAD: unplaced & dated,
        NO_YEAR_OR_WEEK: unplaced,
        NO_STATE: state.isNull(),
        NO_COUNT: F.col("deaths").isNull(),
        NOT_WHOLE: whole["year"].isNull() | whole["week"].isNull() | whole["mmwr_week"].isNull(),
        UNKNOWN_STATE: ~known,
    }
    if rules.relabel_first:
        reasons[NOT_POSITIVE] = unless(F.col("deaths") > 0)
    keys = ["year", "week", "state"]
    tagged = df.withColumn("reason", first_reason(reasons)).withColumns(
        whole | ({"state": relabelled} if rules.relabel_first else {})
    )
    filled = completeness([c for c in df.columns if c not in ORDER_COLUMNS])
    placed = tagged.withColumns({"completeness": filled, "_own": F.monotonically_increasing_id()})
    placed = placed.withColumn("_own", F.when(F.col("reason").isNotNull(), F.col("_own")))
    best = Window.partitionBy(*keys, "_own").orderBy(*best_first(df.columns, keys))
    ranked = placed.withColumns(
        {"_rank": F.row_number().over(best), "_source": F.first("data_source").over(best), "_deaths": F.first("deaths").over(best)}
    )
    late = F.lit(None).cast("string") if rules.relabel_first else F.when(unless(F.col("deaths") > 0), F.lit(NOT_POSITIVE))
    beaten = F.col("reason").isNull() & (F.col("_rank") > 1)
    marked = ranked.withColumns(
        {
            "kept_source": F.when(beaten, F.col("_source")),
            "kept_deaths": F.when(beaten, F.col("_deaths")),
            "reason": F.coalesce(F.col("reason"), F.when(beaten, F.lit(DUPLICATE)), late),
        }
    )
    if not rules.relabel_first:
        marked = marked.withColumn("state", relabelled)
    return marked.drop("completeness", "_own", "_rank", "_source", "_deaths")


def source_conflicts(cleaned: DataFrame) -> DataFrame:
    """How the sources agree where they overlap, from a table that ``mark_cleaning`` tagged.

    kept_source, source, keys, agreeing, difference: for the rows of a source that another's (or its own) row
    displaced, how many there are, how many have the same count, and the sum of the absolute differences.
    """
    lost = cleaned.filter(F.col("reason") == DUPLICATE)
    difference = F.abs(F.col("deaths") - F.col("kept_deaths"))
    return lost.groupBy("kept_source", F.col("data_source").alias("source")).agg(
        F.count(F.lit(1)).alias("keys"),
        F.count(F.when(difference == 0, 1)).alias("agreeing"),
        F.sum(difference).cast("double").alias("difference"),
    )
