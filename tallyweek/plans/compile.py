"""From raw sources to published outputs: the plans under one name."""

from tallyweek.plans.batch import STEPS, compile_landing, rejected_rows
from tallyweek.plans.facts import SOURCES, chart, compile_facts, finish_facts, reports

__all__ = ["SOURCES", "STEPS", "chart", "compile_facts", "compile_landing", "finish_facts", "rejected_rows", "reports"]
