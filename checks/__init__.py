"""Registered queries and the oracle SQL they are checked against."""

from checks import features_and_reports, storage, tables_and_cohort  # noqa: F401  (register on import)
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
