"""From raw sources to the compiled fact table, its reports and charts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.columns import keep_available, typed_empty
from tallyweek.operators.combine import RowCounts, merge_clean
from tallyweek.operators.filters import ALL_STATES, split_national_state
from tallyweek.operators.baseline import with_baselines
from tallyweek.operators.population import MAX_YEARS_BACK, attach_population, population_coverage, with_rate
from tallyweek.operators.quality import (
    coverage,
    coverage_diff,
    summary,
    top_changes,
    validate_yoy,
    yearly_rate,
    yearly_totals,
)
from tallyweek.operators.series import endpoints, series
from tallyweek.rules import DEFAULT, Rules
from tallyweek.schema import FACT, FACT_COLUMNS, JURISDICTIONS, SOURCE
from tallyweek.sources.ingest import (
    ingest_country_series,
    ingest_dated_file,
    ingest_packed_week,
    ingest_provisional,
)

#: source name -> normaliser, in the order in which ties are decided.
SOURCES: dict[str, Callable[[DataFrame, Rules], DataFrame]] = {
    "dated_file": ingest_dated_file,
    "country_series": ingest_country_series,
    "packed_week": ingest_packed_week,
    "provisional": ingest_provisional,
}


def finish_facts(cleaned: DataFrame, population: DataFrame, tolerance: int = MAX_YEARS_BACK) -> DataFrame:
    """Cleaned rows with population and rate, in the output column order."""
    facts = with_rate(attach_population(cleaned, population, tolerance))
    if "week_ending_date" not in facts.columns:
        facts = facts.withColumn("week_ending_date", F.lit(None).cast("string"))
    return keep_available(facts, FACT_COLUMNS)


def compile_facts(
    raw: Mapping[str, DataFrame | None],
    population: DataFrame,
    rules: Rules = DEFAULT,
    jurisdictions: Sequence[str] = tuple(JURISDICTIONS),
    counts: RowCounts | None = None,
) -> DataFrame:
    """Normalise, merge, clean and complete whatever sources are present.

    With ``counts`` the rows after each of STEPS are counted as they pass.
    """
    unknown = set(raw) - set(SOURCES)
    if unknown:
        raise ValueError(f"unknown source(s) {sorted(unknown)}; expected {sorted(SOURCES)}")
    counts = counts or RowCounts()
    nothing = typed_empty(population.sparkSession, SOURCE)
    sources: list[DataFrame | None] = []
    for name, ingest in SOURCES.items():
        source = None if raw.get(name) is None else ingest(counts.watch(raw[name], f"{name} read"), rules)
        if source is not None and source.sameSemantics(nothing):
            counts.seen.pop(f"{name} read")  # it lacks a column and is not read
        elif source is not None:
            source = counts.watch(source, f"{name} normalised")
        sources.append(source)
    cleaned = merge_clean(sources, rules, jurisdictions)
    if cleaned is None:
        return typed_empty(population.sparkSession, FACT)
    return finish_facts(counts.watch(cleaned, "cleaned"), population)


def reports(facts: DataFrame) -> dict[str, DataFrame]:
    """Every check and summary of a compiled table, as report tables."""
    national, states = split_national_state(facts)
    return {
        "national_summary": summary(national, "national"),
        "national_population": population_coverage(national),
        "national_years": yearly_rate(national),
        "state_summary": summary(states, "state"),
        "state_population": population_coverage(states),
        "state_years": yearly_totals(states),
        "state_coverage": coverage(states),
        "validation": validate_yoy(facts),
        "coverage_diff": coverage_diff(facts),
        "top_changes": top_changes(facts),
    }


def chart(facts: DataFrame, kind: str, states: Sequence[str] = (ALL_STATES,)) -> tuple[DataFrame, DataFrame]:
    """Data of one chart of compiled facts: year-by-week points and line ends.

    Compiled facts have one row per year, week and state, as the dedup leaves them.
    """
    points = series(with_baselines(facts, one_row_per_week=True), kind, states)
    return points, endpoints(points)
