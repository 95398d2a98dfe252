"""Weekly event-count surveillance as composable PySpark DataFrame functions."""

from tallyweek.rules import DEFAULT, PARITY, Rules

__all__ = ["DEFAULT", "PARITY", "Rules"]
