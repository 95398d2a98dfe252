"""Helpers decided from column names alone, before anything runs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def keep_available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Project the wanted columns that exist, in the wanted order."""
    return df.select(*(name for name in wanted if name in df.columns))


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def typed_empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))


def _canonical_name(header: str) -> str | None:
    # fixed values: the words that tell a published header
    header = header.lower()
    if "week" in header and "date" in header:
        return "week_ending_date"
    if "jurisdiction" in header:
        return "state"
    if "cause" in header or "death" in header:
        return "deaths"
    return None


def discover_columns(df: DataFrame) -> DataFrame:
    """Rename columns recognised by keyword; refuse an ambiguous layout."""
    found: dict[str, str] = {}
    for header in df.columns:
        name = _canonical_name(header)
        if name is None:
            continue
        if name in found.values() or (name in df.columns and name != header):
            raise ValueError(f"more than one column looks like {name!r}: {df.columns}")
        found[header] = name
    return rename_present(df, found)


def with_week_pair(df: DataFrame) -> DataFrame:
    """Make ``week`` and ``mmwr_week`` copies of each other when one is absent."""
    if "week" not in df.columns and "mmwr_week" in df.columns:
        return df.withColumn("week", F.col("mmwr_week"))
    if "mmwr_week" not in df.columns and "week" in df.columns:
        return df.withColumn("mmwr_week", F.col("week"))
    return df


def compute_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns whose expressions are to be evaluated once a row.

    Filters are pushed below a projection by copying its expressions into them.
    For parsed text that repeats the parse per predicate, and the generated
    method soon outgrows what the JVM compiles (measured: six times slower). A
    generator of one row is where the pushdown stops.
    """
    kept = [F.col(f"`{name}`") for name in df.columns if name not in columns]
    row = F.struct(*(column.alias(name) for name, column in columns.items()))
    return df.select(*kept, F.inline(F.array(row)))


def completeness(columns: Iterable[str]) -> Column:
    """How many of the given cells of a row are filled."""
    filled = [F.col(name).isNotNull().cast("int") for name in columns]
    return sum(filled[1:], filled[0])
