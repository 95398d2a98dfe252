"""Union of sources, best-row deduplication and cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyweek.functions.columns import completeness, compute_once, with_week_pair
from tallyweek.functions.numbers import number_column
from tallyweek.operators.filters import drop_missing, valid_jurisdictions, valid_measure
from tallyweek.rules import DEFAULT, Rules
from tallyweek.schema import CITY, CITY_PARENT, JURISDICTIONS

ORDER_COLUMNS = ["source_ord", "row_ord"]
RELABEL = {CITY: CITY_PARENT}


def union_sources(sources: Sequence[DataFrame | None]) -> DataFrame | None:
    """All sources by column name, in order; absent ones are skipped.

    ``source_ord`` records the order, which decides between equally complete
    rows later. Columns a source lacks are filled with nulls.
    """
    merged = None
    for order, source in enumerate(sources):
        if source is None:
            continue
        source = source.withColumn("source_ord", F.lit(order))
        merged = source if merged is None else merged.unionByName(source, allowMissingColumns=True)
    return merged


def with_completeness(df: DataFrame, name: str = "completeness") -> DataFrame:
    cells = [c for c in df.columns if c not in ORDER_COLUMNS]
    return df.withColumn(name, completeness(cells))


def best_first(columns: Sequence[str], keys: Sequence[str]) -> list[Column]:
    """Order of the rows of one key by completeness and all their columns: the first is the one that stays."""
    order = [F.desc("completeness")]
    order += [F.asc_nulls_last(c) for c in ORDER_COLUMNS if c in columns]
    return order + [F.asc_nulls_last(c) for c in columns if c not in ORDER_COLUMNS and c not in keys]


def dedup_best(df: DataFrame, keys: Sequence[str] = ("year", "week", "state")) -> DataFrame:
    """Most complete row per key; ties go to the earlier source, then row.

    The remaining columns close the order, so the survivor never depends on
    partitioning. The rank filter is applied before the shuffle as well (a
    window group limit), so a key held by a third of all rows sends one row
    per task.
    """
    scored = with_completeness(df)
    best = Window.partitionBy(*keys).orderBy(*best_first(df.columns, keys))
    return (
        scored.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") == 1)
        .drop("rank", "completeness")
    )


def clean(df: DataFrame, rules: Rules = DEFAULT, jurisdictions: Sequence[str] = tuple(JURISDICTIONS)) -> DataFrame:
    """Coerce, drop incomplete rows, deduplicate, relabel, keep known states.

    By default rows without a positive count leave before the dedup, so they
    cannot displace a usable row; with ``relabel_first`` off they leave after.
    """
    essentials = ["year", "state", "deaths", "week"]
    df = drop_missing(with_week_pair(df), essentials)
    number = {c: number_column(df, c, rules.thousands) for c in ("year", "week", "mmwr_week", "deaths")}
    has_text = any(isinstance(df.schema[c].dataType, StringType) for c in number)
    df = compute_once(df, number) if has_text else df.withColumns(number)
    df = drop_missing(df, ["year", "week", "deaths"])
    df = df.withColumns(
        {
            "year": F.col("year").try_cast("int"),
            "week": F.col("week").try_cast("int"),
            "mmwr_week": F.coalesce(F.col("mmwr_week"), F.col("week")).try_cast("int"),
        }
    )
    # a number that is no integer, such as infinity, has become null and is no key
    df = drop_missing(df, ["year", "week", "mmwr_week"])
    # a relabelled row may meet its parent's key, so it is renamed before the
    # dedup unless the historical order is asked for
    if rules.relabel_first:
        df = df.replace(RELABEL, subset=["state"])
        df = dedup_best(valid_measure(valid_jurisdictions(df, jurisdictions)))
    else:
        # only rows that can still end up in the result take part in the dedup:
        # the state is part of its key
        df = dedup_best(valid_jurisdictions(df, [*jurisdictions, *RELABEL]))
        df = valid_measure(df.replace(RELABEL, subset=["state"]))
    return df.drop(*ORDER_COLUMNS)


def merge_clean(
    sources: Sequence[DataFrame | None], rules: Rules = DEFAULT, jurisdictions: Sequence[str] = tuple(JURISDICTIONS)
) -> DataFrame | None:
    merged = union_sources(sources)
    return None if merged is None else clean(merged, rules, jurisdictions)


class RowCounts:
    """Rows after each step, counted inside whatever job consumes the result."""

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame | None, step: str) -> DataFrame | None:
        if df is None:
            return None
        self.seen[step] = Observation(step)
        return df.observe(self.seen[step], F.count(F.lit(1)).alias("rows"))

    def table(self, spark: SparkSession, steps: Sequence[str]) -> DataFrame:
        """step, stage, rows of the steps, 0 for one that had no input; after the job has run."""
        rows = [(at, step, self.seen[step].get["rows"] if step in self.seen else 0) for at, step in enumerate(steps)]
        return spark.createDataFrame(rows, "step int, stage string, rows long")


def row_lineage(merged: DataFrame, keys: Sequence[str] = ("year", "week", "state")) -> DataFrame:
    """Row counts after union, completeness check, dedup and state filter.

    One grouped pass: the groups are the deduplicated rows and their sizes add
    up to the rows before it.
    """
    merged = with_week_pair(merged)
    complete = F.lit(True)
    for name in [*keys, "deaths"]:
        complete = complete & F.col(name).isNotNull()
    known = F.col("state").isin(JURISDICTIONS)
    groups = merged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(complete, 1)).alias("n_complete")
    )
    counts = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("union"),
        F.coalesce(F.sum("n_complete"), F.lit(0)).alias("complete"),
        F.count(F.when(F.col("n_complete") > 0, 1)).alias("dedup"),
        F.count(F.when((F.col("n_complete") > 0) & known, 1)).alias("known_state"),
    )
    stages = counts.columns
    return counts.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(i).alias("step"), F.lit(s).alias("stage"), F.col(s).alias("rows"))
                    for i, s in enumerate(stages)
                )
            )
        )
    )
