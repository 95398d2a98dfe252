"""Year-by-week series, their end points and year bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.functions.columns import missing_columns, typed_empty
from tallyweek.functions.numbers import per_100k, total
from tallyweek.operators.filters import ALL_STATES, select_states, selection_label

KINDS = ("raw", "deaths_per_100k", "deviation_avg", "deviation_expected")
_DEVIATION = {"deviation_avg": "deviation_from_avg", "deviation_expected": "deviation_from_expected"}

# First year, last year, band name and colour.
BANDS = [
    (2015, 2019, "baseline", "#2E8B57"),
    (2020, 2022, "pandemic", "#DC143C"),
    (2023, 2024, "recent", "#FF69B4"),
    (2025, 2025, "current", "#1E90FF"),
]
OTHER_BAND = ("other", "#808080")


def year_band(year: Column) -> tuple[Column, Column]:
    """(band name, colour) of a year."""
    name, colour = F.lit(OTHER_BAND[0]), F.lit(OTHER_BAND[1])
    for first, last, band, shade in BANDS:
        name = F.when(year.between(first, last), F.lit(band)).otherwise(name)
        colour = F.when(year.between(first, last), F.lit(shade)).otherwise(colour)
    return name, colour


def series(
    df: DataFrame,
    kind: str,
    states: Sequence[str] = (ALL_STATES,),
    require_population: bool = False,
) -> DataFrame:
    """One value per year and week over the chosen states.

    * ``raw``: total count;
    * ``deaths_per_100k``: total count over total population. Rows without a
      population still count in the numerator unless ``require_population``;
    * ``deviation_avg`` / ``deviation_expected``: total deviation. Rows without
      a baseline add nothing; ``n_missing_baseline`` says how many there are.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown series {kind!r}; expected one of {KINDS}")
    weeks = ["year", "mmwr_week"]
    chosen = select_states(df, states).dropna(subset=weeks)
    label = F.lit(selection_label(states)).alias("selection")
    if kind == "raw":
        values = chosen.groupBy(*weeks).agg(total(F.col("deaths")).alias("value"))
        return values.select(*weeks, "value", label)
    if kind == "deaths_per_100k":
        if missing_columns(df, ["population"]):
            return typed_empty(
                df.sparkSession,
                T.StructType(
                    [
                        T.StructField("year", T.IntegerType()),
                        T.StructField("mmwr_week", T.IntegerType()),
                        T.StructField("value", T.DoubleType()),
                        T.StructField("selection", T.StringType()),
                    ]
                ),
            )
        if require_population:
            chosen = chosen.filter(F.col("population").isNotNull())
        sums = chosen.groupBy(*weeks).agg(
            total(F.col("deaths")).alias("deaths"), total(F.col("population")).alias("population")
        )
        return sums.select(*weeks, per_100k(F.col("deaths"), F.col("population")).alias("value"), label)
    deviation = F.col(_DEVIATION[kind])
    values = chosen.groupBy(*weeks).agg(
        total(deviation).alias("value"), F.count(F.when(deviation.isNull(), 1)).alias("n_missing_baseline")
    )
    return values.select(*weeks, "value", "n_missing_baseline", label)


def endpoints(points: DataFrame) -> DataFrame:
    """Where each year's line ends: the value at its last week, with its band."""
    last = points.groupBy("year").agg(
        F.max("mmwr_week").alias("mmwr_week"), F.max_by("value", "mmwr_week").alias("value")
    )
    band, colour = year_band(F.col("year"))
    return last.withColumns({"period": band, "colour": colour})
