"""Numeric coercion, rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_number(text: Column, thousands: str | None = None) -> Column:
    """Lenient text-to-double: whatever is not plainly a number becomes null.

    A SQL cast also accepts Java literals such as ``1.0d`` and the word
    ``nan``; neither is a number in a data file. Both end in a letter that no
    other number but infinity ends in, so the last character tells them apart
    without a pattern match on every row.
    """
    text = F.trim(text.cast("string"), F.lit(" \t\r\n"))
    if thousands:
        text = F.replace(text, F.lit(thousands), F.lit(""))
    odd_ending = F.substring(text, -1, 1).isin(*"dDfFnN")
    infinite = F.lower(text).isin("inf", "+inf", "-inf")
    return F.when(~odd_ending | infinite, text.try_cast("double"))


def number_column(df: DataFrame, name: str, thousands: str | None = None) -> Column:
    """A column as double, through text only if it is text."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return to_number(F.col(name), thousands)
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def round_half_even(value: Column, digits: int = 1) -> Column:
    """Scale, round to the nearest even integer, unscale."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null instead of an error on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def pct_change(old: Column, new: Column) -> Column:
    return ratio(new - old, old) * 100.0


def per_100k(count: Column, population: Column) -> Column:
    return ratio(count, population) * 100000.0


def total(value: Column) -> Column:
    """Sum in which a group without any value counts as zero, not null."""
    return F.coalesce(F.sum(value), F.lit(0))


def exact_total(value: Column) -> Column:
    """Sum of doubles to nine decimals, the same in whatever order rows come."""
    return F.coalesce(F.sum(value.cast("decimal(28,9)")), F.lit(0).cast("decimal(38,9)"))


def signed_pct_text(value: Column) -> Column:
    return F.format_string("%+.1f%%", value)


def thousands_text(value: Column, digits: int = 0) -> Column:
    return F.format_number(value, digits)
