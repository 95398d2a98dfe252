"""Date text parsing and epidemiological week numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.columns import compute_once

# The day of the Sunday-to-Saturday week that decides which year owns it:
# the Sunday itself, or the Wednesday (so that at least four days fall inside).
_ANCHOR_DAY = {"first_sunday": 0, "mmwr": 3}


def epi_week(day: Column, rule: str = "mmwr") -> tuple[Column, Column]:
    """(year, week) of a date column; weeks run Sunday to Saturday."""
    if rule not in _ANCHOR_DAY:
        raise ValueError(f"unknown week rule {rule!r}; expected one of {sorted(_ANCHOR_DAY)}")
    anchor = F.date_add(day, F.lit(1 + _ANCHOR_DAY[rule]) - F.dayofweek(day))
    return F.year(anchor), F.floor((F.dayofyear(anchor) + 6) / 7).cast("int")


def week_ending(day: Column) -> Column:
    """The Saturday that closes the week of a date."""
    return F.date_add(day, F.lit(7) - F.dayofweek(day))


def shift_weeks(week: Column, by: int = 1) -> Column:
    """Move weeks earlier, never below week 1; a missing week stays missing."""
    if not by:
        return week
    moved = week - F.lit(by)
    return F.when(moved <= 0, F.lit(1)).otherwise(moved)


def split_year_week(packed: Column) -> tuple[Column, Column]:
    """Split numeric ``YYYYWW`` into its two parts, both truncated to int."""
    return F.floor(packed / 100).try_cast("int"), F.pmod(packed, F.lit(100)).try_cast("int")


_TIME = r"\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?"
_OFFSET = r"( ?(Z|[+-]\d{2}:?\d{2}))"
_NAMED = r"^(\p{L}+,? +)?(\p{L}{3,9}\.? +\d{1,2}|\d{1,2}[ -]+\p{L}{3,9}\.?),?[ -]+(\d{4})$"
#: Beginnings of English month names, in order.
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()

#: Two-digit years up to this one are of the 2000s, later ones of the 1900s.
CENTURY_PIVOT = 68


def parse_date(text: Column, offset_dates: bool = True, pivot: int = CENTURY_PIVOT) -> Column:
    """Date from text in any of the accepted spellings, else null.

    Accepted: year-month-day with dashes, slashes, dots or nothing between, ISO
    date and time, month or day first with slashes or dashes (also with a
    two-digit year or a time), and English month names before or after the day,
    full or shortened, with or without commas and a weekday. Month-first goes
    before day-first, so ``1/5/2019`` is 5 January and ``13/02/2019`` is 13
    February. A two-digit year up to ``pivot`` is of the 2000s.

    The parts are put in year-month-day order for one cast, much cheaper than
    trying one pattern parser after another. Every spelling is gated by its
    shape, because the cast alone would accept bare years and trailing text.
    """
    text = F.trim(text.cast("string"))
    year_first = (
        r"^\d{4}(/\d{1,2}/\d{1,2}|-\d{1,2}-\d{1,2}|\.\d{1,2}\.\d{1,2}|-\d{2}-\d{2}[T ]"
        + _TIME
        + (_OFFSET + "?" if offset_dates else "")
        + ")$"
    )
    day = F.substring_index(F.substring_index(text, "T", 1), " ", 1)
    by_year = F.translate(day, "/.", "--").try_cast("date")
    by_digits = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)).try_cast("date")

    year_last = r"^(\d{1,2}/\d{1,2}/(\d{4}|\d{2})|\d{1,2}-\d{1,2}-\d{4})( " + _TIME + r"( ?[AaPp][Mm])?)?$"
    day = F.translate(F.substring_index(text, " ", 1), "-", "/")
    first = F.substring_index(day, "/", 1)
    pair = F.substring_index(day, "/", 2)
    year = F.substring_index(day, "/", -1)
    century = F.when(F.length(year) == 4, F.lit("")).when(year <= f"{pivot:02d}", F.lit("20")).otherwise(F.lit("19"))
    month_first = (F.length(first) == 1) | (first <= "12")
    swapped = F.concat(F.substring_index(pair, "/", -1), F.lit("-"), first)
    month_day = F.when(month_first, F.translate(pair, "/", "-")).otherwise(swapped)
    by_parts = F.concat(century, year, F.lit("-"), month_day).try_cast("date")

    named = F.regexp_extract(text, _NAMED, 2)
    name = F.lower(F.regexp_extract(named, r"(\p{L}+)", 1))
    # a beginning of a month's name that is long enough to tell, or its whole name; "sept" is one
    month = F.array_position(F.array(*(F.lit(m) for m in _MONTHS)), F.substring(name, 1, 3))
    full = F.date_format(F.make_date(F.lit(2000), F.nullif(month, F.lit(0)).cast("int"), F.lit(1)), "MMMM")
    spelled = F.lower(full).startswith(name) & (F.length(name) >= 3)
    by_name = F.when(
        spelled,
        F.concat_ws("-", F.regexp_extract(text, _NAMED, 3), month.cast("string"), F.regexp_extract(named, r"(\d+)", 1)).try_cast("date"),
    )
    return (
        F.when(text.rlike(year_first), by_year)
        .when(text.rlike(year_last), by_parts)
        .when(text.rlike(r"^\d{8}$"), by_digits)
        .when(text.rlike(_NAMED), by_name)
    )


def unparsed_dates(df: DataFrame, column: str = "week_ending_date", offset_dates: bool = True) -> DataFrame:
    """Date texts that are not understood, with their number of rows; nulls are not texts."""
    texts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("text")).agg(F.count(F.lit(1)).alias("rows"))
    parsed = compute_once(texts, {"day": parse_date(F.col("text"), offset_dates)})
    return parsed.filter(F.col("day").isNull()).select("text", "rows")
