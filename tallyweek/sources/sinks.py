"""Writers. Outputs are editions (see ``publish``): tables of a run, published together."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.columns import keep_available
from tallyweek.operators.filters import split_national_state
from tallyweek.schema import FACT_COLUMNS
from tallyweek.sources.publish import Edition, following, if_present, latest, publish

#: how a partition of rows without a year is named.
NO_YEAR = "__HIVE_DEFAULT_PARTITION__"
#: Small jobs that run side by side.
WRITERS = 6


def together(*jobs: Callable[[], object]) -> list:
    """Run small independent jobs side by side, as none of them fills a cluster; their results, or the first error."""
    with ThreadPoolExecutor(WRITERS) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def write_csv(df: DataFrame, path: str, sort: list[str]) -> None:
    """Header, overwrite, globally sorted: part files follow the sort order."""
    keep_available(df, FACT_COLUMNS).orderBy(*(c for c in sort if c in df.columns)).write.mode(
        "overwrite"
    ).option("header", True).option("escape", '"').csv(path)


def write_years(df: DataFrame, out: str, name: str, run: str, inner: tuple[str, ...] = ()) -> dict[str, str]:
    """Parquet partitioned by year and run for pruned reads; the partitions written, year -> folder.

    The rebalance hint lets the adaptive planner size the files: small years
    are packed together, an oversized year is split over several writers.
    """
    rows = df.withColumn("run", F.lit(run)).hint("rebalance", "year")
    rows.write.mode("append").partitionBy("year", "run", *inner).parquet(f"{out}/{name}")
    spark = df.sparkSession
    written = if_present(lambda: spark.read.option("basePath", f"{out}/{name}").parquet(f"{out}/{name}/year=*/run={run}"))
    years = [] if written is None else [r.year for r in written.select("year").distinct().collect()]
    parts = {NO_YEAR if year is None else str(year) for year in years}
    return {part: f"{name}/year={part}/run={run}" for part in parts}


def write_extracts(table: DataFrame, out: str, run: str) -> dict[str, dict[str, str]]:
    """The national and the state extract of a compiled table that can be read back.

    An extract without rows is a header, so no earlier run's rows stay behind.
    """
    national, states = split_national_state(table)
    together(
        lambda: write_csv(national, f"{out}/national/run={run}", ["year", "week"]),
        lambda: write_csv(states, f"{out}/states/run={run}", ["year", "week", "state"]),
    )
    return {name: {"": f"{name}/run={run}"} for name in ("national", "states")}


def write_outputs(facts: DataFrame, out: str) -> dict[str, str]:
    """Publish the compiled table plus its national and state extracts.

    The facts are computed once, into the table; both extracts read that table
    back, so nothing is recomputed and a lost executor costs one task. Readers
    see the three of one run or the three of another.
    """
    from tallyweek.sources.scan import read_years

    out = out.rstrip("/")
    spark = facts.sparkSession
    edition = Edition(*following(latest(spark, out)))
    compiled = write_years(facts, out, "compiled", edition.run)
    table = read_years(spark, out, "compiled", compiled)
    edition = replace(edition, tables={"compiled": compiled} | write_extracts(table, out, edition.run))
    publish(spark, out, edition)
    return places(edition, out)


def places(edition: Edition, out: str) -> dict[str, str]:
    """Where the tables of an edition are; the yearly ones are read through ``scan_compiled`` and its like."""
    return {name: f"{out}/{parts['']}" if list(parts) == [""] else f"{out}/{name}" for name, parts in edition.tables.items()}


def write_reports(reports: Mapping[str, DataFrame], out: str, run: str) -> dict[str, dict[str, str]]:
    """Each report as lines of JSON in a folder of its name; they hold lists and maps."""
    together(*(partial(report.write.json, f"{out}/reports/{name}/run={run}") for name, report in reports.items()))
    return {name: {"": f"reports/{name}/run={run}"} for name in reports}
