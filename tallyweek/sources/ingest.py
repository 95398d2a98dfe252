"""Four source layouts, each normalised to ``schema.SOURCE_COLUMNS``.

Inputs are all-text DataFrames as they come from ``scan_csv``. A layout that
lacks a required column yields a typed empty result, with a warning. A
``row_ord`` column, where present, is carried along for deterministic dedup.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tallyweek.functions.calendar import epi_week, parse_date, shift_weeks, split_year_week
from tallyweek.functions.columns import (
    compute_once,
    discover_columns,
    keep_available,
    missing_columns,
    rename_present,
    typed_empty,
)
from tallyweek.functions.numbers import number_column
from tallyweek.operators.filters import exclude_totals, of_country, valid_measure, valid_week
from tallyweek.operators.fold import fold_entities
from tallyweek.rules import DEFAULT, Rules
from tallyweek.schema import (
    COUNTRY_SERIES_NAMES,
    LABEL_COUNTRY_SERIES,
    LABEL_DATED_FILE,
    LABEL_PACKED_WEEK,
    LABEL_PROVISIONAL,
    NATIONAL,
    PACKED_WEEK_KEY,
    PACKED_WEEK_NAMES,
    PROVISIONAL_NAMES,
    SOURCE,
    SOURCE_COLUMNS,
)

log = logging.getLogger(__name__)


def unusable(df: DataFrame, required: list[str], source: str) -> bool:
    """Whether a layout lacks a column it needs, with a warning."""
    absent = missing_columns(df, required)
    if absent:
        log.warning("%s: column(s) %s not found, source treated as empty", source, absent)
    return bool(absent)


def _unusable(df: DataFrame, required: list[str], source: str) -> DataFrame | None:
    return typed_empty(df.sparkSession, SOURCE) if unusable(df, required, source) else None


def _finish(df: DataFrame, label: str) -> DataFrame:
    return keep_available(df.withColumn("data_source", F.lit(label)), [*SOURCE_COLUMNS, "row_ord"])


def _typed(df: DataFrame, numbers: dict[str, str], rules: Rules) -> DataFrame:
    """Numeric columns, from text where they are text.

    Parsed text is computed once per row; numbers are taken as they are, so that
    filters on them reach the scan.
    """
    found = {name: number_column(df, text, rules.thousands) for name, text in numbers.items()}
    parsed = {name: value for name, value in found.items() if isinstance(df.schema[numbers[name]].dataType, StringType)}
    df = compute_once(df, parsed) if parsed else df
    return df.withColumns({name: value for name, value in found.items() if name not in parsed})


def _in_years(df: DataFrame, name: str, first: int, last: int | None = None) -> DataFrame:
    """Rows of the years; on a column that is a number in the source, before anything is computed from it."""
    bounds = F.col(name) >= first if last is None else F.col(name).between(first, last)
    return df.filter(bounds) if isinstance(df.schema[name].dataType, NumericType) else df


def _with_day(df: DataFrame, rules: Rules) -> DataFrame:
    """The parsed date as a column of its own, for the rows that are still left."""
    return compute_once(df, {"day": parse_date(F.col("week_ending_date"), rules.offset_dates)})


def _one_spelling(df: DataFrame) -> DataFrame:
    """One spelling per date, so that equal weeks meet when folded."""
    iso = F.col("day").cast("string")
    return df.withColumn("week_ending_date", F.coalesce(iso, F.col("week_ending_date").cast("string")))


def ingest_dated_file(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Single-year file: columns found by keyword, weeks derived from dates."""
    df = discover_columns(df)
    empty = _unusable(df, ["state", "deaths"], LABEL_DATED_FILE)
    if empty is not None:
        return empty
    df = valid_measure(_typed(exclude_totals(df), {"deaths": "deaths"}, rules))
    # rows of one date text are summed before any date is parsed: sums of sums are the same sums
    df = fold_entities(keep_available(df, ["week_ending_date", "state", "deaths", "row_ord"]), how=rules.fold)
    year = F.lit(None if rules.dated_file_year is None else float(rules.dated_file_year)).cast("double")
    if "week_ending_date" in df.columns:
        df = _with_day(df, rules)
        own_year, week = epi_week(F.col("day"), rules.week_rule)
        df = df.withColumns(
            {"week": shift_weeks(week, rules.dated_file_shift).cast("double"), "year": F.coalesce(year, own_year.cast("double"))}
        )
        df = df if rules.text_dates else _one_spelling(df)
    else:
        log.warning("%s: no week-ending date, weeks are unknown", LABEL_DATED_FILE)
        df = df.withColumns({"week": F.lit(None).cast("double"), "year": year})
    df = _finish(df.withColumn("mmwr_week", F.col("week")), LABEL_DATED_FILE)
    # dates that were one text each are one row each already
    return df if rules.text_dates else fold_entities(df, how=rules.fold)


def ingest_country_series(
    df: DataFrame, rules: Rules = DEFAULT, country: str = NATIONAL, years: tuple[int, int] = (2015, 2020)
) -> DataFrame:
    """Multi-country file: one country's weeks become the national series."""
    empty = _unusable(df, ["country_name", "year", "time", "deaths"], LABEL_COUNTRY_SERIES)
    if empty is not None:
        return empty
    df = of_country(df, country)
    if rules.weekly_only and "time_unit" in df.columns:
        df = df.filter(F.col("time_unit") == "weekly")
    df = _in_years(rename_present(df, COUNTRY_SERIES_NAMES), "year", *years)
    df = _typed(df, {"year": "year", "week": "week", "deaths": "deaths"}, rules)
    df = df.filter(F.col("year").between(*years))
    df = valid_week(df) if rules.check_weeks else df
    df = df.withColumns({"state": F.lit(NATIONAL), "mmwr_week": F.col("week")})
    return _finish(df, LABEL_COUNTRY_SERIES)


def ingest_provisional(df: DataFrame, rules: Rules = DEFAULT, first_year: int = 2020) -> DataFrame:
    """State by week file with separate year and week columns."""
    df = rename_present(df, PROVISIONAL_NAMES)
    empty = _unusable(df, ["year", "mmwr_week", "state", "total_deaths"], LABEL_PROVISIONAL)
    if empty is not None:
        return empty
    df = _typed(_in_years(df, "year", first_year), {"year": "year", "mmwr_week": "mmwr_week", "deaths": "total_deaths"}, rules)
    df = valid_week(valid_measure(df.filter(F.col("year") >= first_year)), "mmwr_week")
    df = _finish(df.withColumn("week", F.col("mmwr_week")), LABEL_PROVISIONAL)
    df = fold_entities(df, how=rules.fold)
    if "week_ending_date" in df.columns and not rules.text_dates:
        df = fold_entities(_one_spelling(_with_day(df, rules)).drop("day"), how=rules.fold)
    return keep_available(df, [*SOURCE_COLUMNS, "row_ord"])


def ingest_packed_week(
    df: DataFrame, rules: Rules = DEFAULT, years: tuple[int, int] = (2015, 2018), age: str = "All"
) -> DataFrame:
    """Archived state file: year and week packed into one ``YYYYWW`` number."""
    df = rename_present(df, PACKED_WEEK_NAMES)
    empty = _unusable(df, ["age", PACKED_WEEK_KEY, "state", "deaths"], LABEL_PACKED_WEEK)
    if empty is not None:
        return empty
    # this layout has no date of its own; ignore one that happens to be there
    df = df.filter(F.col("age") == age).drop("week_ending_date")
    df = _typed(df, {"packed": PACKED_WEEK_KEY, "deaths": "deaths"}, rules)
    year, week = (part.cast("double") for part in split_year_week(F.col("packed")))
    df = df.withColumns({"year": year, "week": week, "mmwr_week": week})
    df = valid_week(valid_measure(df.filter(F.col("year").between(*years))), "week")
    return fold_entities(_finish(df, LABEL_PACKED_WEEK), how=rules.fold)
