"""The four source layouts with every row kept: typed cells, and the reason a row leaves.

The kept rows, folded, are what ``ingest`` gives for the layout. A rejected row carries
itself as ``raw`` text, so that what the batch lost can be looked up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.functions.calendar import epi_week, parse_date, shift_weeks, split_year_week
from tallyweek.functions.columns import compute_once, discover_columns, rename_present
from tallyweek.functions.numbers import number_column
from tallyweek.operators import reject
from tallyweek.operators.fold import fold_entities
from tallyweek.rules import DEFAULT, Rules
from tallyweek.schema import (
    COUNTRY_SERIES_NAMES,
    LABEL_COUNTRY_SERIES,
    LABEL_DATED_FILE,
    LABEL_PACKED_WEEK,
    LABEL_PROVISIONAL,
    NATIONAL,
    NATIONAL_VARIANTS,
    PACKED_WEEK_KEY,
    PACKED_WEEK_NAMES,
    PROVISIONAL_NAMES,
    SOURCE,
)
from tallyweek.sources.ingest import unusable
from tallyweek.sources.scan import MALFORMED

#: layouts without a date of their own.
UNDATED = {"country_series", "packed_week"}


def _marked(df: DataFrame, label: str, cells: dict[str, Column], reasons: dict[str, Column], rules: Rules) -> DataFrame:
    """SOURCE columns, row_ord, reason and raw of a table whose parsed cells are columns already."""
    if MALFORMED in df.columns:
        line = F.col(MALFORMED)
        if rules.malformed == "fail":
            # the message is the reason, should a row without one ever get here
            broken = F.when(line.isNotNull(), F.raise_error(F.concat(F.lit(f"{label}: malformed line: "), line)).cast("boolean"))
            reasons = {reject.MALFORMED_LINE: F.coalesce(broken, F.lit(False))} | reasons
        elif rules.malformed == "drop":
            reasons = {reject.MALFORMED_LINE: line.isNotNull()} | reasons
        elif rules.malformed != "keep":
            raise ValueError(f"unknown rule for malformed lines {rules.malformed!r}")
    else:
        line = F.lit(None).cast("string")
    cells = cells | {"data_source": F.lit(label)}
    typed = [cells.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SOURCE.fields]
    order = [F.col("row_ord")] if "row_ord" in df.columns else []
    tagged = df.select(*typed, *order, reject.first_reason(reasons).alias("reason"), F.coalesce(line, F.col("_raw")).alias("_raw"))
    return tagged.withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("_raw"))).drop("_raw")


def _with_raw(df: DataFrame) -> DataFrame:
    cells = [F.col(f"`{name}`") for name in df.columns if name not in ("row_ord", MALFORMED)]
    return df.withColumn("_raw", F.to_json(F.struct(*cells)))


def _numbers(df: DataFrame, texts: dict[str, str], rules: Rules) -> dict[str, Column]:
    return {name: number_column(df, text, rules.thousands) for name, text in texts.items()}


def _counted(deaths: str = "_deaths") -> dict[str, Column]:
    return {reject.NO_COUNT: F.col(deaths).isNull(), reject.NOT_POSITIVE: reject.unless(F.col(deaths) > 0)}


def _spelling(rules: Rules) -> Column:
    """One spelling per date, so that equal weeks meet when folded, unless dates are compared as text."""
    text = F.col("week_ending_date").cast("string")
    return text if rules.text_dates else F.coalesce(F.col("_day").cast("string"), text)


def mark_dated_file(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame | None:
    df = discover_columns(_with_raw(df))
    if unusable(df, ["state", "deaths"], LABEL_DATED_FILE):
        return None
    cells = {"state": F.col("state"), "deaths": F.col("_deaths")}
    parsed = _numbers(df, {"_deaths": "deaths"}, rules)
    forced = F.lit(None if rules.dated_file_year is None else float(rules.dated_file_year)).cast("double")
    if "week_ending_date" in df.columns:
        parsed["_day"] = parse_date(F.col("week_ending_date"), rules.offset_dates)
        own_year, week = epi_week(F.col("_day"), rules.week_rule)
        week = shift_weeks(week, rules.dated_file_shift)
        cells |= {"year": F.coalesce(forced, own_year.cast("double")), "week": week, "mmwr_week": week, "week_ending_date": _spelling(rules)}
    else:
        cells["year"] = forced
    reasons = {reject.NATIONAL_TOTAL: F.coalesce(F.col("state").isin(NATIONAL_VARIANTS), F.lit(False))} | _counted()
    return _marked(compute_once(df, parsed), LABEL_DATED_FILE, cells, reasons, rules)


def mark_country_series(
    df: DataFrame, rules: Rules = DEFAULT, country: str = NATIONAL, years: tuple[int, int] = (2015, 2020)
) -> DataFrame | None:
    if unusable(df, ["country_name", "year", "time", "deaths"], LABEL_COUNTRY_SERIES):
        return None
    df = rename_present(_with_raw(df), COUNTRY_SERIES_NAMES)
    df = compute_once(df, _numbers(df, {"_year": "year", "_week": "week", "_deaths": "deaths"}, rules))
    reasons = {reject.OTHER_COUNTRY: reject.unless(F.col("country") == country)}
    if rules.weekly_only and "period_type" in df.columns:
        reasons[reject.NOT_WEEKLY] = reject.unless(F.col("period_type") == "weekly")
    reasons[reject.OUTSIDE_YEARS] = reject.unless(F.col("_year").between(*years))
    if rules.check_weeks:
        reasons[reject.NO_VALID_WEEK] = reject.unless((F.col("_week") > 0) & (F.col("_week") <= 53))
    cells = {"year": F.col("_year"), "week": F.col("_week"), "mmwr_week": F.col("_week"), "state": F.lit(NATIONAL), "deaths": F.col("_deaths")}
    return _marked(df, LABEL_COUNTRY_SERIES, cells, reasons, rules)


def mark_provisional(df: DataFrame, rules: Rules = DEFAULT, first_year: int = 2020) -> DataFrame | None:
    df = rename_present(_with_raw(df), PROVISIONAL_NAMES)
    if unusable(df, ["year", "mmwr_week", "state", "total_deaths"], LABEL_PROVISIONAL):
        return None
    parsed = _numbers(df, {"_year": "year", "_week": "mmwr_week", "_deaths": "total_deaths"}, rules)
    cells = {"year": F.col("_year"), "week": F.col("_week"), "mmwr_week": F.col("_week"), "state": F.col("state"), "deaths": F.col("_deaths")}
    if "week_ending_date" in df.columns:
        if not rules.text_dates:
            parsed["_day"] = parse_date(F.col("week_ending_date"), rules.offset_dates)
        cells["week_ending_date"] = _spelling(rules)
    reasons = {reject.OUTSIDE_YEARS: reject.unless(F.col("_year") >= first_year)} | _counted()
    reasons[reject.NO_VALID_WEEK] = reject.unless((F.col("_week") > 0) & (F.col("_week") <= 53))
    return _marked(compute_once(df, parsed), LABEL_PROVISIONAL, cells, reasons, rules)


def mark_packed_week(
    df: DataFrame, rules: Rules = DEFAULT, years: tuple[int, int] = (2015, 2018), age: str = "All"
) -> DataFrame | None:
    df = rename_present(_with_raw(df), PACKED_WEEK_NAMES)
    if unusable(df, ["age", PACKED_WEEK_KEY, "state", "deaths"], LABEL_PACKED_WEEK):
        return None
    df = compute_once(df, _numbers(df, {"_packed": PACKED_WEEK_KEY, "_deaths": "deaths"}, rules))
    year, week = (part.cast("double") for part in split_year_week(F.col("_packed")))
    reasons = {
        reject.OTHER_AGE: reject.unless(F.col("age") == age),
        reject.OUTSIDE_YEARS: reject.unless(year.between(*years)),
    } | _counted()
    reasons[reject.NO_VALID_WEEK] = reject.unless((week > 0) & (week <= 53))
    cells = {"year": year, "week": week, "mmwr_week": week, "state": F.col("state"), "deaths": F.col("_deaths")}
    return _marked(df, LABEL_PACKED_WEEK, cells, reasons, rules)


#: source name -> tagging function; None where the layout lacks a column it needs.
MARKS: dict[str, Callable[[DataFrame, Rules], DataFrame | None]] = {
    "dated_file": mark_dated_file,
    "country_series": mark_country_series,
    "packed_week": mark_packed_week,
    "provisional": mark_provisional,
}


def normalised(name: str, rows: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """The kept rows of a tagged source as ``ingest`` gives them: without the tags, and folded."""
    drop = ["reason", "raw", *(["week_ending_date"] if name in UNDATED else [])]
    rows = rows.drop(*drop)
    return rows if name == "country_series" else fold_entities(rows, how=rules.fold)


def marked_layout(order: T.DataType | None) -> T.StructType:
    """Columns of a tagged source; ``order`` is the type of row_ord."""
    fields = [*SOURCE.fields, *([T.StructField("row_ord", order)] if order else [])]
    return T.StructType([*fields, T.StructField("reason", T.StringType()), T.StructField("raw", T.StringType())])
