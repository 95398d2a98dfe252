"""Behaviour switches.

``DEFAULT`` is what a new user wants. ``PARITY`` keeps every historical quirk,
so that published figures can be reproduced digit for digit.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    #: "mmwr" (week 1 holds at least four days of the year) or "first_sunday".
    week_rule: str = "mmwr"
    #: weeks subtracted from the dated single-year file, floored at week 1.
    dated_file_shift: int = 0
    #: year forced onto the dated single-year file; None takes each date's own.
    dated_file_year: int | None = None
    #: thousands separator accepted in numeric text; None nulls such text.
    thousands: str | None = None
    #: accept date text carrying a UTC offset (its local date is used).
    offset_dates: bool = True
    #: fold and dedup compare week-ending dates as raw text, not as dates.
    text_dates: bool = False
    #: map child names to their parent before (not after) deduplication.
    relabel_first: bool = True
    #: keep only rows whose time unit is weekly in the country series.
    weekly_only: bool = True
    #: drop rows of the country series whose week is not between 1 and 53.
    check_weeks: bool = True
    #: "drop" (reject and count), "keep" (cells as far as they go) or "fail": lines with too few or too many cells.
    malformed: str = "drop"
    #: "sum", "data" or "none"; see ``operators.fold.fold_entities``.
    fold: str = "sum"


DEFAULT = Rules()
PARITY = Rules(
    week_rule="first_sunday",
    dated_file_shift=1,
    dated_file_year=2019,
    offset_dates=False,
    text_dates=True,
    relabel_first=False,
    weekly_only=False,
    check_weeks=False,
    malformed="keep",
    fold="data",
)
